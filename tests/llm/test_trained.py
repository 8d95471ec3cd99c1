from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from catchframe.llm import langid, lm, toxicity

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def remainder(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_language_of_held_out_documents(odd, prose, nothing):
    docs = prose(150)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = langid.predict_held_out(docs).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 150 and all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in found)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9
    rows = {r.doc_id: r for r in langid.predict_held_out(odd).collect()}
    assert rows[2].lang_pred == rows[3].lang_pred == rows[4].lang_pred == "und" and rows[2].score == 0.0
    assert langid.predict_held_out(nothing).count() == 0


def test_mixture_of_languages(prose):
    model = langid.fit(prose(150))
    texts = {lang: next(r.text for r in prose(150).collect() if r.lang == lang and len(r.text) > 400) for lang in ("en", "de")}
    (name,), (score,), (shares,) = langid.infer([texts["en"][:300] + " " + texts["de"][:600]], model)
    assert set(shares) == {"en", "de"} and name == "de" and 0.5 < score < 0.8 and abs(sum(shares.values()) - 1) < 1e-9
    (_,), (alone,), (one,) = langid.infer([texts["en"]], model)
    assert one == {"en": 1.0} and alone == 1.0


def test_more_languages_than_a_table_of_256(spark):
    """Every language is learned: three hundred of them, each with letters of its own."""
    letter = lambda i, k: chr(0x4E00 + 7 * i + k)
    rows = [(j * 300 + i, " ".join(letter(i, (j + k) % 7) * 2 for k in range(60)), f"l{i:03}") for i in range(300) for j in range(3)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(model.languages) == 300
    names, scores, _ = langid.infer([t for _, t, _ in rows[:600]], model)
    assert np.mean([n == lang for n, (_, _, lang) in zip(names, rows)]) > 0.98 and min(scores) > 0.5


@pytest.fixture
def toxic(spark, prose):
    """Documents of which every fourth has listed words, and labels for two thirds."""
    rows = []
    for r in prose(400).collect():
        bad = r.doc_id % 4 == 0
        text = f"{r.text} trash {r.text[:20]} scumword idiot" if bad else r.text
        rows.append((r.doc_id, text, int(bad)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string").selectExpr("*", "'own' AS score")
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows if i % 3], "doc_id long, quality int, toxic int")
    return docs, labels, {i: t for i, _, t in rows}


def test_toxicity(spark, toxic, odd, nothing):
    docs, labels, truth = toxic
    found = toxicity.predict_held_out(docs, labels).collect()
    assert len(found) == 400 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    lexicon = toxicity.fit(docs, labels)
    assert " trash " in lexicon.weights
    disguised = spark.createDataFrame([(1, "you TRΑSH and 1di0t, ѕcumword tr@sh"), (2, "fine text"), (3, None), (4, "")], "doc_id long, text string")
    got = {r.doc_id: r.predicted for r in toxicity.score(disguised, lexicon).collect()}
    assert got == {1: 1, 2: 0, 3: 0, 4: 0}
    empty = toxicity.predict_held_out(odd, labels.limit(0)).collect()
    assert len(empty) == odd.count() and all(r.predicted == 0 for r in empty)
    assert toxicity.predict_held_out(nothing, labels).count() == 0


def test_harmless_phrases():
    lexicon = toxicity.Lexicon({" trash ": 2.0, " scum": 3.0}, frozenset({"trash bin"}), (0.0, 1.0, 0.0))
    total = lambda text: math.expm1(toxicity.Matcher(lexicon).measure(text)[0])
    assert total("trash bin") == pytest.approx(0) and total("trash") == pytest.approx(2) and total("scumbag, trash") == pytest.approx(5)


def test_lattice_sums_over_all_segmentations():
    model = lm.lattice(PIECES)
    logs = np.concatenate([[-np.inf], np.log(model.weights / model.weights.sum())])
    index = {p: i + 1 for i, p in enumerate(model.pieces)}

    def total(text):
        if not text:
            return 1.0
        return sum(math.exp(logs[index[text[:k]]]) * total(text[k:]) for k in range(1, len(text) + 1) if text[:k] in index)

    words = [b"the", b"th", "éa".encode(), b"\xff", b"tion", b"q"]
    got = model.log_probability(words, logs)
    assert all(abs(g - math.log(total(b" " + w))) < 1e-9 for g, w in zip(got, words))
    # Expected uses: the bytes of the pieces used make up the words.
    uses = model.expected(words, np.ones(len(words)), logs)
    assert sum(u * len(p) for u, p in zip(uses[1:], model.pieces)) == pytest.approx(sum(len(w) + 1 for w in words))
    assert np.isfinite(model.log_probability([b"x" * 20_000], logs)).all()


def test_scores(odd, prose, nothing):
    docs = prose(60)
    tokens = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r.text)), None] for r in docs.collect()}
    train = Counter(t for i, ts in tokens.items() if remainder(i, 7) != 2 for t in ts)
    n, v = sum(train.values()), len(train)
    found = lm.score(docs, PIECES).collect()
    assert len(found) == 60
    for r in found:
        ts = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(r.doc_id, 7) == 2, len(ts), sum(train[t] > 0 for t in ts), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[t] + 1) / (n + v + 1)) for t in ts)) and r.score < 0
    rows = lm.score(odd, PIECES).collect()
    assert len(rows) == odd.count()
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1 and all(math.isfinite(r.score) for r in rows)
    assert lm.score(nothing, PIECES).count() == 0


def test_scores_follow_the_mix_of_words_and_lattice(spark):
    """All scores against plain Python: every segmentation is listed, in the fit and in the sum."""
    texts = ["the cat sat", "The  cat", "éa q", "tion the", "zz the \x85 sat", "", None, "cat cat on", "unseen on", "the tion a", "on a q", "Sat"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    tokens = {i: [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))] for i, t in enumerate(texts)}
    kept = [i for i in tokens if remainder(i, 7) != 2]
    assert 0 < len(kept) < len(texts)
    words, ends = Counter(w for i in kept for w in tokens[i]), len(kept)

    model = lm.lattice(PIECES)
    share = dict(zip(model.pieces, model.weights / model.weights.sum()))

    def ways(text):
        if not text:
            return [[]]
        return [[text[:k], *rest] for k in range(1, len(text) + 1) if text[:k] in share for rest in ways(text[k:])]

    def spelt(word):
        return sum(math.prod(share[p] for p in way) for way in ways(b" " + word))

    for _ in range(3):
        uses = Counter()
        for word in words:
            whole = spelt(word)
            for way in ways(b" " + word):
                for piece in way:
                    uses[piece] += math.prod(share[p] for p in way) / whole
        mass = sum(uses.values()) + 0.01 * len(share)
        share = {p: (uses[p] + 0.01) / mass for p in share}

    once, twice = (sum(c == k for c in words.values()) for k in (1, 2))
    discount = once / (once + 2 * twice)
    # All training tokens, their ends, and the one that the pieces have besides.
    total = sum(words.values()) + ends + 1

    def probability(word):
        return max(words[word] - discount, 0) / total + (discount * len(words) + 1) / total * spelt(word)

    found = {r.doc_id: r.score for r in lm.score(docs, PIECES).collect()}
    assert sorted(found) == sorted(tokens)
    for i, score in found.items():
        assert score == pytest.approx(sum(math.log10(probability(w)) for w in tokens[i]) + math.log10(ends / total), abs=1e-9)
