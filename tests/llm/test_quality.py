from __future__ import annotations

import re
from collections import Counter

from catchframe.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_counts(odd, prose, nothing):
    for df in (odd, prose(60)):
        for r in quality.features(df).collect():
            assert tuple(r[c] for c in quality.COUNTS) == counts(r.text)
    assert quality.count_text("a b c a b c a") == (7, 7, 0, 0, 7)
    assert quality.count_text("x\x1cy z") == (1, 5, 0, 0, 0)
    assert quality.features(nothing).count() == 0


def host_rows(spark, sizes):
    rows = [(h, n) for h, (good, bad) in sizes.items() for n in [100] * good + [3] * bad]
    return spark.createDataFrame(rows, "source string, n_words long").selectExpr(
        "source", "n_words", "0L AS word_chars", "0L AS n_symbols", "0L AS n_dup_lines", "0L AS n_repeat_words"
    )


def test_hosts_are_shrunk(spark):
    sizes = {f"h{i}": (90, 10 + i % 9) for i in range(20)} | {"junk": (40, 160), "half": (50, 55), "new": (0, 1), None: (50, 5)}
    verdicts = {r.host: r for r in quality.host_verdicts(host_rows(spark, sizes), "source").collect()}
    assert set(verdicts) == set(sizes) and verdicts["junk"].docs == 200 and verdicts["junk"].few_words == 160
    assert [h for h, r in verdicts.items() if not r.host_kept] == ["junk"]
    # One failed document alone does not reject a host, nor does a rate that may be half by chance.
    assert verdicts["new"].few_words_rate < 0.8 and verdicts["half"].few_words_rate > 0.4
    assert 0.05 < verdicts["h3"].few_words_rate < 0.2
    alone = quality.host_verdicts(host_rows(spark, {"a": (10, 90)}), "source").first()
    assert alone.host_kept


def test_a_junk_host_changes_verdicts(spark, prose):
    """Its documents go though they break no base rule; those of other hosts stay.  The SQL says the same."""
    import duckdb

    from catchframe.llm.queries import QUALITY_SQL

    words = " ".join(f"w{i}" for i in range(80))
    rows = [(10_000 + i, words + (" #" * 20 if i % 5 else ""), "en", "junk", 0) for i in range(100)]
    docs = prose(200).unionByName(spark.createDataFrame(rows, prose(1).schema))
    found = {r.doc_id: r for r in quality.verdicts_of(docs).collect()}
    assert not any(found[i].kept for i, *_ in rows) and not any(found[i].base_failed for i, *_ in rows)
    assert all(r.kept == (not r.base_failed) for i, r in found.items() if i < 10_000)
    documents = docs.toPandas()  # noqa: F841
    want = {r[0]: r[1:] for r in duckdb.sql(QUALITY_SQL).fetchall()}
    assert {i: tuple(r)[1:] for i, r in found.items()} == want
    assert {r.doc_id for r in quality.keep_good(docs).collect()} == {i for i, r in found.items() if r.kept}


def test_verdicts_and_filter(spark, odd, prose, nothing):
    docs = prose(80)
    found = {r.doc_id: r for r in quality.verdicts_of(docs).collect()}
    assert len(found) == 80
    for r in docs.collect():
        n = counts(r.text)
        assert found[r.doc_id].base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (found[r.doc_id].base_failed and found[r.doc_id].kept)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}
    assert quality.keep_good(odd).columns == odd.columns and quality.keep_good(odd).count() >= 0
    assert quality.verdicts_of(odd).count() == odd.count()
    assert quality.keep_good(nothing).count() == 0


def test_symbols(spark):
    """The pipeline's stage takes out symbol junk."""
    plain = " ".join(f"w{i}" for i in range(100))
    junk = plain + " #" * 12
    rows = [(i, t, "en", "a" if i < 4 else "b", len(t)) for i, t in enumerate([plain, plain + " #" * 10, junk, plain] + [junk] * 60 + [plain])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in quality.keep_good(df).collect()} == {0, 1, 3, 64}
    verdicts = quality.host_verdicts(quality.features(df), "source").collect()
    assert {r.host: r.symbols for r in verdicts} == {"a": 1, "b": 60}
