"""Language identification by mixture inference.

A model has, for each language, the probability of hashed letter trigrams.  A document is a
mixture of languages: expectation-maximisation finds the proportions that make its trigrams
most likely.  Languages enter in the order of their proportions, and the set is the one with
the best likelihood after a penalty per language that grows with the log of the length.
All documents of a batch go through the steps together, as segments of one array.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.llm.bpe import LETTER, SENTINEL, class_table
from catchframe.llm.common import id_remainder, map_arrow, pieces, with_columns_of_text

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
UNKNOWN = "und"
CELLS = 1 << 23


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each trigram around a letter, and the number of the text that it is in.

    Letters are in lower case; everything else is one kind of gap.
    """
    parts = [np.frombuffer((t.lower() + "\n" if t else "\n").encode("utf-32-le"), dtype=np.uint32) for t in texts]
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    codes = np.concatenate(parts)
    letters = class_table()[codes] == LETTER
    codes = np.where(letters, codes, np.uint32(32)).astype(np.uint64)
    before = np.concatenate([[np.uint64(32)], codes[:-1]])
    after = np.concatenate([codes[1:], [np.uint64(32)]])
    mixed = (before * np.uint64(SENTINEL) + codes) * np.uint64(SENTINEL) + after
    bucket = (mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return bucket[letters].astype(np.int64), owner[letters]


@dataclass(frozen=True)
class Model:
    """Languages in the order of their names, and the log probability of each bucket in each."""

    languages: tuple[str, ...]
    logs: np.ndarray


def fit(docs: DataFrame, language: str = "lang", column: str = "text") -> Model:
    """Count the trigrams of all given documents that have a text and a language.

    Every language is learned: the model has a quarter of a megabyte for each, whatever the number of documents.
    The counts of a task are summed before the shuffle; one number per language and bucket comes to the driver.
    """
    known = docs.where(F.col(language).isNotNull() & F.col(column).isNotNull()).select(
        F.col(language).alias("lang"), F.col(column).alias("text")
    )
    languages = tuple(sorted(r.lang for r in known.select("lang").distinct().collect()))
    place = {name: i for i, name in enumerate(languages)}

    def run(batches):
        total = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                bucket, owner = trigrams(part.column(1).to_pylist())
                lang = np.array([place.get(x, -1) for x in part.column(0).to_pylist()], dtype=np.int64)[owner]
                for i in np.unique(lang[lang >= 0]).tolist():
                    counts = np.bincount(bucket[lang == i], minlength=BUCKETS)
                    total[i] = total.get(i, 0) + counts
        for i, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i, dtype=np.int64)), pa.array(at.astype(np.int64)), pa.array(counts[at].astype(np.int64))],
                names=["lang", "bucket", "n"],
            )

    sums = map_arrow(known, run, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(languages), BUCKETS))
    got = sums.toArrow()
    counts[np.asarray(got.column("lang")), np.asarray(got.column("bucket"))] = np.asarray(got.column("n"))
    for row in counts:
        row += 0.5
        np.log(row / row.sum(), out=row)
    return Model(languages, counts.astype(np.float32))


def _mixture(like: np.ndarray, times: np.ndarray, starts: np.ndarray, sizes: np.ndarray, share: np.ndarray, rounds: int):
    """Proportions per document and the log likelihood, from ``like`` (entries x languages)."""
    total = np.add.reduceat(times, starts)
    for _ in range(rounds):
        joint = like * np.repeat(share, sizes, axis=0)
        joint *= (times / joint.sum(axis=1))[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / total[:, None]
    fit_ = (like * np.repeat(share, sizes, axis=0)).sum(axis=1)
    return share, np.add.reduceat(times * np.log(fit_), starts)


def infer(texts: list[str | None], model: Model, rounds: int = 12) -> tuple[list[str], list[float], list[dict]]:
    """Main language, its proportion, and all proportions of the chosen set for each text.

    A text without a letter, or with nothing learned, is ``und`` with 0.  Texts go through the steps in groups
    whose trigrams times languages fit ``CELLS``, so memory does not grow with the number of languages.
    """
    names, scores, sets, start = [], [], [], 0
    while start < len(texts):
        end, cells = start, 0
        while end < len(texts) and (end == start or cells < CELLS):
            cells += min(len(texts[end] or ""), BUCKETS) * max(len(model.languages), 1)
            end += 1
        for whole, part in zip((names, scores, sets), _infer(texts[start:end], model, rounds)):
            whole += part
        start = end
    return names, scores, sets


def _infer(texts: list[str | None], model: Model, rounds: int) -> tuple[list[str], list[float], list[dict]]:
    names, scores, sets = [UNKNOWN] * len(texts), [0.0] * len(texts), [{} for _ in texts]
    n_lang = len(model.languages)
    bucket, owner = trigrams(texts)
    if not n_lang or not len(bucket):
        return names, scores, sets
    keys, times = np.unique(owner * BUCKETS + bucket, return_counts=True)
    owner, bucket, times = keys // BUCKETS, keys % BUCKETS, times.astype(float)
    documents, starts, sizes = np.unique(owner, return_index=True, return_counts=True)
    logs = model.logs[:, bucket].T.astype(float)
    like = np.exp(logs - logs.max(axis=1, keepdims=True))
    top = np.add.reduceat(times * logs.max(axis=1), starts)
    length = np.add.reduceat(times, starts)
    share, _ = _mixture(like, times, starts, sizes, np.full((len(documents), n_lang), 1.0 / n_lang), rounds)
    order = np.argsort(-share, axis=1, kind="stable")
    # One language: no mixture to fit.
    alone = np.add.reduceat(times[:, None] * logs, starts, axis=0)
    first = alone.argmax(axis=1)
    best = np.zeros_like(share)
    best[np.arange(len(documents)), first] = 1.0
    gain = alone.max(axis=1)
    going = np.arange(len(documents))
    for m in range(2, n_lang + 1):
        # Only documents that the last language helped try one more.
        chosen = np.zeros((len(going), n_lang))
        np.put_along_axis(chosen, order[going, :m], 1.0 / m, axis=1)
        pick = np.repeat(np.isin(np.arange(len(documents)), going), sizes)
        at = np.concatenate([[0], np.cumsum(sizes[going])[:-1]])
        fitted, value = _mixture(like[pick], times[pick], at, sizes[going], chosen, rounds)
        value += top[going] - (m - 1) * 2.0 * np.log(length[going] + 1.0)
        better = value > gain[going]
        best[going[better]], gain[going[better]] = fitted[better], value[better]
        going = going[better]
        if not len(going):
            break
    main = best.argmax(axis=1)
    for i, d in enumerate(documents.tolist()):
        names[d], scores[d] = model.languages[main[i]], float(best[i, main[i]])
        sets[d] = {model.languages[j]: float(best[i, j]) for j in np.flatnonzero(best[i] > 0).tolist()}
    return names, scores, sets


def identify(df: DataFrame, model: Model, column: str = "text") -> DataFrame:
    """All columns of ``df``, ``lang_pred``, ``lang_score`` and ``lang_shares`` (map) of the whole text."""
    context = df.sparkSession.sparkContext.broadcast(model)  # bounded by languages x buckets

    def make():
        def run(texts):
            names, scores, sets = infer(texts, context.value)
            return [pa.array(names), pa.array(scores), pa.array([list(s.items()) for s in sets], pa.map_(pa.string(), pa.float64()))]

        return run

    shares = T.MapType(T.StringType(), T.DoubleType())
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType()), T.StructField("lang_shares", shares)]
    return with_columns_of_text(df, column, make, fields)


def predict_held_out(docs: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``; learned from rows whose id has another remainder than ``held``.

    A missing id is a training row.  Only the text is an input of a prediction.
    """
    marked = docs.select("doc_id", "text", "lang", (id_remainder("doc_id", modulus) == held).alias("held_out"))
    model = fit(marked.where("NOT held_out"))
    found = identify(marked.drop("lang"), model)
    return found.select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))
