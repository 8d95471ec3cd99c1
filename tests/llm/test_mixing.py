from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
from catchframe.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, cap=3):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        share = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / share > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / share for s in free}
        for s in over:
            out[s] = float(cap * sizes[s])
            free.discard(s)
        left = float(sum(sizes.values())) - sum(out.values())
    return out


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 0, "b": 0}, {"z": 7}, {"a": 1, "b": 1, "c": 100_000, "d": 4}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        want = targets(sizes)
        assert set(got) == set(want) and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_report(odd, prose, nothing):
    docs = prose(150)
    rows = mixing.mix_report(docs, block_words=500).join(docs.select("doc_id", "source", "text"), "doc_id").collect()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len(WORD.findall(r.text)) and 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
    want, taken = targets(sizes), Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    again = mixing.mix_report(docs.repartition(7), block_words=500)
    assert {(r.doc_id, r.taken) for r in again.collect()} == {(r.doc_id, r.taken) for r in rows}
    assert mixing.mix_report(odd).count() == odd.count() and mixing.mix_report(nothing).count() == 0


def test_hypergeometric(spark):
    """Mean and variance of many draws, and the bounds."""
    good, rest, draws, n = 30, 70, 40, 4_000
    sql = mixing.hypergeometric_sql("u", "good", "rest", "draws")
    df = spark.range(n).selectExpr(f"(id + 0.5D) / {n} AS u", f"{good}L AS good", f"{rest}L AS rest", f"{draws}L AS draws")
    got = [r.k for r in df.selectExpr(f"{sql} AS k").collect()]
    mean, var = sum(got) / n, sum((k - 12) ** 2 for k in got) / n
    assert abs(mean - 12) < 0.02 and abs(var - draws * 0.3 * 0.7 * 60 / 99) < 0.05 and got == sorted(got)
    sure = spark.sql(f"SELECT {sql} AS k FROM VALUES (0.5D, 0L, 5L, 3L), (0.5D, 4L, 0L, 3L), (0.9D, 4L, 4L, 8L), (0.1D, 4L, 4L, 0L) AS t(u, good, rest, draws)")
    assert [r.k for r in sure.collect()] == [0, 3, 4, 0]


def test_tree_gives_exact_quotas(spark):
    quotas = {"a": 17, "b": 400, None: 3, "d": 0}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    for shards in (1, 5, 8):
        rows = mixing.split_quotas(df, shards, 7).collect()
        per_source, per_shard = Counter(), Counter()
        for r in rows:
            assert r.blocks >= 0
            per_source[r.source] += r.blocks
            per_shard[r.shard] += r.blocks
        assert all(per_source[s] == q for s, q in quotas.items())
        assert len(per_shard) == shards and max(per_shard.values()) - min(per_shard.values()) <= 3


def test_taken_comes_from_the_tree(spark, prose, monkeypatch):
    """A tree that draws nothing takes nothing; one with a single shard the same words."""
    docs = prose(150)
    want = {r.doc_id: r.taken for r in mixing.mix_report(docs, block_words=500).collect()}
    real = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", lambda q, shards, seed: real(q, shards, seed).where("false"))
    assert {r.taken for r in mixing.mix_report(docs, block_words=500).collect()} == {0}
    assert mixing.mixed(docs, block_words=500).count() == 0
    monkeypatch.setattr(mixing, "split_quotas", lambda q, shards, seed: real(q, 1, seed))
    assert {r.doc_id: r.taken for r in mixing.mix_report(docs, block_words=500).collect()} == want


def test_shards_are_disjoint_and_even(spark, prose):
    mix = mixing.plan_mix(prose(150), shards=5, block_words=300)
    drawn = mix.drawn.collect()
    assert len({(r.source, r.draw) for r in drawn}) == len(drawn) and mix.shards == 5
    sizes = Counter(r.shard for r in drawn)
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 3
    assert mixing.plan_mix(prose(20)).shards == mixing.LEAST_SHARDS


def test_mixed_documents(odd, prose, nothing):
    docs = prose(100)
    report = {r.doc_id: r.taken for r in mixing.mix_report(docs, block_words=300).collect()}
    out = mixing.mixed(docs, shards=4, block_words=300)
    assert out.columns == docs.columns and out.rdd.getNumPartitions() == 4
    texts = {r.doc_id: r.text for r in docs.collect()}
    words = Counter()
    for r in out.collect():
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({i: n for i, n in report.items() if n})
    assert mixing.mixed(odd).columns == odd.columns and mixing.mixed(odd).count() > 0
    assert mixing.mixed(nothing).count() == 0


def test_whole_documents(spark, prose):
    """No text of the pipeline's mix is cut; a source misses its target by half of its last document at most."""
    docs = prose(100)
    texts = {r.doc_id: (r.text, r.source) for r in docs.collect()}
    report = mixing.mix_report(docs).collect()
    target, longest, words = {}, Counter(), Counter()
    for r in report:
        source = texts[r.doc_id][1]
        target[source], longest[source] = r.target, max(longest[source], r["size"])
    assert any(0 < r.last_pass < r["size"] for r in report)
    for r in corpus_pipeline.mix_sources(spark, docs, "").collect():
        assert r.text == texts[r.doc_id][0] and r.n_chars == len(r.text)
        words[r.source] += len(WORD.findall(r.text))
    assert all(abs(words[s] - t) <= longest[s] / 2 + 0.5 for s, t in target.items())
