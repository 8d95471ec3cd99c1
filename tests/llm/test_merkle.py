from __future__ import annotations

import hashlib
import zlib

from pyspark.sql import functions as F

import pytest

from catchframe.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, tampered=False):
    out = ""
    for c in merkle.FIELDS:
        v = row[c]
        if tampered and c == "text" and v is not None:
            v = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in v)
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(out)


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 16 * 16
        out.append(("".join(level[start:i]), "".join(level[i + 1:start + 16])))
        i //= 16
    return out


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r.source, []).append(r)
    trees = []
    for s in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        members = sorted(by_source[s], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r)))
        trees.append((members, levels_of([leaf_of(r) for r in members])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    out = []
    for k, (members, levels) in enumerate(trees):
        for i, r in enumerate(members):
            path = siblings(levels, i) + siblings(top, k)
            x = leaf_of(r, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            for before, after in path:
                x = h(before + x + after)
            root = top[-1][0]
            out.append((r.doc_id, levels[0][i], levels[-1][0], root, h("".join(a + b for a, b in path)), x, x == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_report_against_brute_force(spark, prose):
    """Trees of height 0 to 3, and sources enough for a tree of their own."""
    docs = prose(400).withColumn("text", F.initcap("text")).withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") < 60, F.concat(F.lit("ü"), F.col("doc_id") % 40)).otherwise(F.col("source"))
    )
    found = merkle.tamper_report(docs)
    assert got(found) == brute(docs.collect())
    assert found.where("NOT verified").count() > 20


def test_odd_rows(spark, odd, nothing):
    """Missing ids, sources and texts, repeated rows, a long text and other columns called like the operator's."""
    docs = odd.withColumns({"tree": F.lit("x"), "n": F.lit(1), "digest": F.lit(2), "leaf": F.lit("y"), "root": F.lit("z")})
    assert got(merkle.tamper_report(docs)) == brute(odd.collect())
    assert merkle.tamper_report(nothing).collect() == []
    one = odd.where("doc_id = 7")
    row = merkle.tamper_report(one).first()
    assert row.leaf == row.subroot == row.root == leaf_of(one.first()) and row.proof_sha256 == h("")


def test_some_requests_and_lost_records(spark, prose):
    rows = prose(300).select("doc_id", "source", F.sha2("text", 256).alias("leaf"))
    made = merkle.build(rows, "source", "doc_id")
    asked = made.leaves.where("doc_id % 50 = 0").select("tree", "n", "doc_id", "leaf")
    found = merkle.descend(made, asked).withColumn("to", merkle.folded(F.col("leaf"), F.col("path")))
    assert found.count() == 6 and found.where((F.col("to") == made.root) & (F.col("digest") == F.col("leaf"))).count() == 6
    beyond = spark.createDataFrame([(0, 10_000, 1)], "tree long, n long, doc_id int")
    assert merkle.descend(made, beyond).collect() == []
    broken = merkle.Manifest(made.leaves, made.groups, made.records.where("height > 1"), made.root, made.height)
    with pytest.raises(Exception, match="no record of node"):
        merkle.descend(broken, asked).collect()


def test_a_source_is_ranked_in_many_partitions(spark):
    """Half of the rows share their source, a third is one row: ranks still run from 0 without a gap."""
    rows = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit("s").alias("source"), F.lit("l").alias("leaf")
    )
    made = merkle.build(rows, "source", "doc_id")
    assert sorted(r.n for r in made.leaves.select("n").collect()) == list(range(6000))
    assert made.groups.first().subroot == levels_of(["l"] * 6000)[-1][0]
