"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton on folded text.

Folding undoes disguise: case, accents, look-alike letters of other scripts, and digits or
signs that stand for letters inside a word.  The lexicon holds words and word beginnings
whose share in toxic documents is far above that in others, with their log odds as
weights.  Phrases in which a listed word is harmless take its weight back.  The sum of the
weights, as such and by the length of the text, gives the score through a logistic curve.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.llm.common import id_remainder, map_arrow, stored, with_columns_of_text

# Letters of other scripts that look like Latin ones, and signs that replace letters.
LOOK_ALIKES = str.maketrans({
    "а": "a", "в": "b", "е": "e", "з": "3", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ո": "n", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
})
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"})
INSIDE = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<![^\W_])[0134578@$]+(?=[^\W\d_]{2})")
WORDS = re.compile(r"[^\W\d_]+")
HINT = re.compile(r"[0134578@$!|]")
PREFIXES = range(4, 9)


def fold(text: str | None) -> list[str]:
    """Words of a text with the disguises undone."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        text = "".join(c for c in text if not unicodedata.combining(c)).translate(LOOK_ALIKES)
    if HINT.search(text):
        text = INSIDE.sub(lambda m: m.group().translate(SIGNS), text)
    return WORDS.findall(text)


def entries(word: str) -> list[str]:
    """Lexicon entries that a word can match: itself between blanks, and its beginnings."""
    return [f" {word} ", *[f" {word[:k]}" for k in PREFIXES if k < len(word)]]


@dataclass(frozen=True)
class Lexicon:
    """Weights of entries, harmless phrases, and the logistic curve (constant, sum, density)."""

    weights: dict[str, float]
    harmless: frozenset[str]
    curve: tuple[float, float, float]


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry, (len(entry), weight))
        if lexicon.weights:
            self.automaton.make_automaton()

    def hits(self, words: list[str]) -> dict[int, float]:
        """Best weight at each start of a listed word in the joined text."""
        best: dict[int, float] = {}
        if words and self.lexicon.weights:
            for end, (size, weight) in self.automaton.iter(f" {' '.join(words)} "):
                start = end - size + 1
                if weight > best.get(start, 0.0):
                    best[start] = weight
        return best

    def phrases(self, words: list[str], hits: dict[int, float]) -> list[tuple[int, str]]:
        """The listed word with the word before it and with the one after it."""
        if not hits:
            return []
        starts = dict(zip(np.cumsum([0, *[len(w) + 1 for w in words]]).tolist(), range(len(words))))
        out = []
        for start in hits:
            i = starts[start]
            if i:
                out.append((start, f"{words[i - 1]} {words[i]}"))
            if i + 1 < len(words):
                out.append((start, f"{words[i]} {words[i + 1]}"))
        return out

    def measure(self, text: str | None) -> tuple[float, float]:
        """Sum of weights without harmless phrases, and the sum per hundred words."""
        words = fold(text)
        hits = self.hits(words)
        if self.lexicon.harmless:
            for start, phrase in self.phrases(words, hits):
                if phrase in self.lexicon.harmless:
                    hits.pop(start, None)
        total = sum(hits.values())
        return np.log1p(total), np.log1p(100.0 * total / (len(words) + 20.0))


def _log_odds(t: np.ndarray, c: np.ndarray, n_t: int, n_c: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds ratio and its standard score, with half a document added to each cell."""
    cells = [t + 0.5, n_t - t + 0.5, c + 0.5, n_c - c + 0.5]
    odds = np.log(cells[0]) - np.log(cells[1]) - np.log(cells[2]) + np.log(cells[3])
    return odds, odds / np.sqrt(sum(1.0 / x for x in cells))


def _counts(sample: DataFrame, listed, least: int) -> list:
    """Documents of either kind per item that ``listed`` finds in a text, with ``least`` at least."""
    def run(batches):
        tox, clean = Counter(), Counter()
        find = listed()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                (tox if toxic else clean).update(find(text))
        names = list(tox.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([tox[k] for k in names], pa.int64()), pa.array([clean[k] for k in names], pa.int64())],
            names=["item", "tox", "clean"],
        )

    sums = map_arrow(sample, run, "item string, tox long, clean long").groupBy("item").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    return sums.where(F.col("tox") + F.col("clean") >= least)


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, least_docs: int = 5) -> Lexicon:
    """Lexicon and curve from ``doc_id``, ``text`` of ``docs`` and ``doc_id``, ``toxic`` of ``labels``.

    The model is fitted to the documents of at most ``sample_rows`` labels, those with the
    smallest hash of the id; the lexicon has all entries that ``least_docs`` documents of the sample bear
    out, so the sample alone bounds it.  Texts are not shuffled to find them; the sample is stored.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", (F.col("toxic") > 0).alias("toxic")).distinct()
    picked = known.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", "toxic").limit(sample_rows)
    # At most sample_rows ids: small by the bound.
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")
    spark = docs.sparkSession
    sample = stored(found.repartition(spark.sparkContext.defaultParallelism * 2), "labelled_sample")
    if sample.isEmpty():
        return Lexicon({}, frozenset(), (-2.0, 1.0, 0.0))
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_t, n_c = sizes.get(True, 0), sizes.get(False, 0)

    def all_entries():
        return lambda text: {e for w in set(fold(text)) for e in entries(w)}

    # An entry needs toxic documents, and relatively more of them than of others.
    often = _counts(sample, all_entries, least_docs).where(
        (F.col("tox") >= least_docs) & (F.col("tox") * max(n_c, 1) > 8 * F.col("clean") * max(n_t, 1))
    ).orderBy("item").collect()
    names = [r.item for r in often]
    odds, sure = _log_odds(np.array([r.tox for r in often], dtype=float), np.array([r.clean for r in often], dtype=float), n_t, n_c)
    weights = {n: float(o) for n, o, z in zip(names, odds.tolist(), sure.tolist()) if o > 0 and z > 4.0}
    first = Lexicon(weights, frozenset(), (0.0, 0.0, 0.0))

    def all_phrases():
        matcher = Matcher(first)

        def find(text):
            words = fold(text)
            return {p for _, p in matcher.phrases(words, matcher.hits(words))}

        return find

    # Harmless: in several clean documents, and no more likely in toxic ones than anything else.
    calm = _counts(sample, all_phrases, least_docs).where(
        (F.col("clean") >= least_docs) & (F.col("tox") * max(n_c, 1) <= F.col("clean") * max(n_t, 1))
    ).orderBy("item").collect()
    second = Lexicon(weights, frozenset(r.item for r in calm), (0.0, 0.0, 0.0))
    rows = measured(sample, second).select("tox_sum", "tox_density", "toxic").collect()
    x = np.array([(1.0, r.tox_sum, r.tox_density) for r in rows])
    y = np.array([float(r.toxic) for r in rows])
    return Lexicon(weights, second.harmless, tuple(_logistic(x, y).tolist()))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def measured(df: DataFrame, lexicon: Lexicon, column: str = "text") -> DataFrame:
    """All columns of ``df``, ``tox_sum`` and ``tox_density`` of the whole text."""
    def make():
        matcher = Matcher(lexicon)

        def run(texts):
            got = np.array([matcher.measure(t) for t in texts], dtype=float).reshape(len(texts), 2)
            return [pa.array(got[:, 0]), pa.array(got[:, 1])]

        return run

    return with_columns_of_text(df, column, make, [T.StructField(c, T.DoubleType()) for c in ("tox_sum", "tox_density")])


def score(df: DataFrame, lexicon: Lexicon, column: str = "text", threshold: float = 0.3) -> DataFrame:
    """All columns of ``df``, ``score`` between 0 and 1 and ``predicted`` (1 from ``threshold`` on).

    A missing or empty text has the score of a text without any listed word.
    """
    a, b, c = lexicon.curve
    line = F.lit(a) + F.col("tox_sum") * b + F.col("tox_density") * c
    done = measured(df.drop("score", "predicted"), lexicon, column).withColumn("score", 1 / (1 + F.exp(-line)))
    return done.withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("tox_sum", "tox_density")


def predict_held_out(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``; learned from labels of ids with another remainder.

    A missing id has no label and is not held out.  Only the text is an input of a score.
    """
    marked = docs.select("doc_id", "text", (id_remainder("doc_id", modulus) == held).alias("held_out"))
    train = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(id_remainder("doc_id", modulus) != held)
    lexicon = fit(marked.where("NOT held_out"), train)
    return score(marked, lexicon).select("doc_id", "held_out", "score", "predicted")
