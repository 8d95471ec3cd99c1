from __future__ import annotations

import hashlib
import re
import sys
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
import xxhash

import __spark_entry__ as contract
import corpus_pipeline
from catchframe.llm import pii

sys.path.insert(0, str(Path(__file__).parent))

from test_mixing import targets  # noqa: E402
from test_quality import counts  # noqa: E402
from test_simhash import fingerprint, groups  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture
def folder(prose, tmp_path):
    prose(200).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_stages_keep_the_columns(spark, folder, prose):
    docs = prose(200)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_copies", "personal_data", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:2]:
        before, docs = docs.count(), stage(spark, docs, folder)
        assert docs.columns == prose(1).columns and 0 < docs.count() < before, name


def hashed(seed, *values):
    """Spark's xxhash64 of an int seed and of longs and texts, each hash the next one's seed; missing values are left out."""
    h = xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), 42)
    for v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v.encode(), h)
    return h


def mixed_by_hand(docs, block_words=1 << 17):
    """How often each document is taken: whole passes, then blocks of the permuted order until the rest is reached."""
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len(WORD.findall(d.text))
    times = Counter()
    for source, target in targets(sizes).items():
        words = round(target)
        passes, rest = divmod(words, sizes[source])
        n_blocks = max(-(-sizes[source] // block_words), 1)
        width = ((1 << 62) - 1) // n_blocks + 1
        place = {d.doc_id: hashed(7, d.doc_id, d.text, d.lang) & ((1 << 62) - 1) for d in docs if d.source == source}
        left = rest
        for d in sorted((d for d in docs if d.source == source), key=lambda d: (place[d.doc_id] // width, place[d.doc_id], d.doc_id)):
            size = len(WORD.findall(d.text))
            part, left = min(size, left), max(left - size, 0)
            times[d.doc_id] += passes + (part > 0 and 2 * part >= size)
    return times


def by_hand(spark, docs):
    """All stages in plain Python; personal data as its operator replaces them in a text of its own."""
    good = []
    for d in docs:
        n, _, symbols, _, repeated = counts(d.text)
        if n >= 50 and 100 * repeated <= 50 * n and 10 * symbols <= n:
            good.append(d)
    prints = {d.doc_id: fingerprint(d.text) for d in good}
    near = [(a, b) for a, b in combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    kept = set(groups(near, prints).values())
    one = spark.createDataFrame([d for d in good if d.doc_id in kept], spark.createDataFrame(docs[:1]).schema)
    clean = pii.replace(one, "one key").collect()
    times, out = mixed_by_hand(clean), Counter()
    for d in clean:
        out[d.doc_id, hashlib.sha256(d.text.encode()).hexdigest()] += times[d.doc_id]
    return +out


def test_run_against_brute_force(spark, prose, tmp_path):
    docs = [r.asDict() for r in prose(200).collect()]
    for d in docs[::9]:
        d["text"] += f" mail me at user{d['doc_id']}@example.com or call 415-555-0{100 + d['doc_id']}"
    docs[3]["text"] += " #$%&*" * 60
    docs[4]["source"] = None
    df = spark.createDataFrame(docs, prose(1).schema)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set(pii.KEY_SETTING, "one key")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    spark.conf.unset(pii.KEY_SETTING)
    want = by_hand(spark, df.collect())
    assert Counter((r.doc_id, r.decoded_sha256) for r in rows) == want and sum(want.values()) > 100
    assert all(r.n_tokens > 0 and len(r.ids_sha256) == 64 for r in rows)


def test_run_on_odd_rows_and_on_none(spark, odd, nothing, tmp_path):
    """Missing, empty and blank texts and repeated rows go; the long text stays."""
    odd.write.parquet(str(tmp_path / "a" / "documents.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path / "a")).collect()
    assert {r.doc_id for r in rows} <= {5} and all(r.n_tokens > 0 for r in rows)
    nothing.write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).collect() == []


def test_working_folders_are_removed(spark, folder):
    from catchframe.session import working_folders

    before = set(working_folders())
    corpus_pipeline.run(spark, folder)
    left = [f for f in working_folders() if f not in before]
    assert len(left) == len(corpus_pipeline.STAGES) and all(Path(f.removeprefix("file:")).exists() for f in left)


def test_registered():
    ops = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in ops) == list(range(1, 14))
    assert "pipeline" in contract.queries()
