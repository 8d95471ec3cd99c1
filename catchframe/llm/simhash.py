"""SimHash near-duplicates with pigeonring filtering.

A fingerprint of 64 bits is cut into five segments on a ring.  If two fingerprints differ
in at most four bits, some segment starts a chain whose first k segments differ in at most
k * 4 / 5 bits, for every k.  So the first segment is equal and the first two differ in one
bit at most: probes of the chain of two with no or one flipped bit are an equi-join key
of 25 or 26 bits.  Chains of three and four prune what is left before the full distance.

Equal fingerprints are grouped first.  A key that holds more fingerprints than ``crowd``
is not joined, since a dense cluster would give a pair for each two of its members.
Fingerprints that probe such a key are linked by centres instead: two fingerprints are
within four bits exactly if some third word is within two bits of both.  All fingerprints
around one centre are linked to its smallest one, so the work is linear in the cluster.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from catchframe.llm.common import stored, with_columns_of_text
from catchframe.llm.components import components

BITS = 64
WIDTHS = (13, 13, 13, 13, 12)
STARTS = tuple(accumulate((0, *WIDTHS[:-1])))
DISTANCE = 4
CROWD = 32
# More fingerprints than this give short keys of a quarter of ``CROWD`` members by chance.
MOST_SHORT = (CROWD // 4) << 25
# The place of a key's first segment stands above its chain.
PLACE = 40


def fingerprint(text: str | None, size: int, seed: int) -> int:
    """SimHash of the shingles of ``size`` words, lower case for A-Z; 0 without words."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    k = min(size, len(words))
    firsts = np.concatenate([[0], ends[:len(words) - k] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(firsts, ends[k - 1:].tolist())], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return int(value)


def fingerprints(
    df: DataFrame, column: str = "text", out: str = "fp", size: int = 4, seed: int = 42, keep: bool = True
) -> DataFrame:
    """All columns of ``df`` and the fingerprint of the whole text as a long of the same bits.

    A missing, empty or blank text has fingerprint 0.  Without ``keep`` the text is left out.
    """
    def make():
        def run(texts):
            values = np.array([fingerprint(t, size, seed) for t in texts], dtype=np.uint64)
            return [pa.array(values.view(np.int64))]

        return run

    return with_columns_of_text(df, column, make, [T.StructField(out, T.LongType(), False)], keep)


def rotated(word: str, by: int) -> str:
    """SQL text of the word with its bits ``by`` to the left, round the ring."""
    return f"(shiftleft({word}, {by}) | shiftrightunsigned({word}, {BITS - by}))" if by else word


def chain_width(start: int, length: int) -> int:
    return sum(WIDTHS[(start + k) % len(WIDTHS)] for k in range(length))


def budget(length: int, distance: int = DISTANCE) -> int:
    """Bits in which a chain of so many segments may differ."""
    return length * distance // len(WIDTHS)


def _key(start: int, word: str, length: int) -> str:
    """The chain of so many segments, and the place where it starts above it, in one long."""
    chain = f"shiftrightunsigned({rotated(word, STARTS[start])}, {BITS - chain_width(start, length)})"
    return f"({start << PLACE}L | {chain})"


def _keys(word: str, length: int, flipped: int) -> Column:
    """Keys of all chains, as they are and with one bit of the segments after the first ``flipped`` changed."""
    chains = []
    for i in range(len(WIDTHS)):
        free = chain_width(i, length) - chain_width(i, flipped)
        flips = ", ".join(f"{m}L" for m in (0, *(1 << b for b in range(free))))
        chains.append(f"transform(array({flips}), m -> {_key(i, word, length)} ^ m)")
    return F.expr(f"concat({', '.join(chains)})")


def index_keys(word: str, length: int = 2) -> Column:
    """Keys that a fingerprint is found by: its chains of two; of three also with one bit flipped."""
    return _keys(word, length, length if length == 2 else 1)


def probe_keys(word: str, length: int = 2) -> Column:
    """Keys that a fingerprint looks for: its chains with none or one bit after the first segment flipped."""
    return _keys(word, length, 1)


def chain_holds(a: str, b: str, start: int) -> str:
    """The chains of two and more segments from ``start`` stay within their budgets; the last is the whole word."""
    differ = rotated(f"({a} ^ {b})", STARTS[start])
    return " AND ".join(
        f"bit_count({f'shiftrightunsigned({differ}, {BITS - chain_width(start, k)})' if k < len(WIDTHS) else differ}) <= {budget(k)}"
        for k in range(2, len(WIDTHS) + 1)
    )


def links(distinct: DataFrame, crowd: int = CROWD, most_short: int = MOST_SHORT) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs within four bits.

    ``distinct`` has each fingerprint once in ``fp``.  Pairs outside crowded keys are all
    there, some of them repeated; around a centre of a crowded cluster each member is linked to the
    smallest.  More than ``most_short`` fingerprints take the longer keys.
    """
    length = 2 if distinct.count() <= most_short else 3
    index = distinct.select("fp", F.explode(index_keys("fp", length)).alias("key"))
    probes = distinct.select(F.col("fp").alias("a"), F.explode(probe_keys("fp", length)).alias("key"))
    crowded = stored(index.groupBy("key").count().where(F.col("count") > crowd).select("key"), "crowded_keys")
    single = index.join(crowded, "key", "left_anti").withColumnRenamed("fp", "b")
    fits = " ".join(f"WHEN {i} THEN {chain_holds('a', 'b', i)}" for i in range(len(WIDTHS)))
    pairs = probes.join(single, "key").where(
        f"a != b AND CASE shiftrightunsigned(key, {PLACE}) {fits} END"
    ).select("a", "b")
    dense = probes.join(crowded, "key", "left_semi").select("a").distinct()
    return pairs.unionByName(centre_links(dense))


def centre_links(members: DataFrame) -> DataFrame:
    """Each fingerprint linked to the smallest one around each word within two bits of both."""
    near = members.withColumn("bits", F.expr(f"transform(sequence(0, {BITS - 1}), b -> shiftleft(1L, b))")).select(
        "a", F.explode(F.expr(
            "concat(array(0L), bits, flatten(transform(bits, (m, i) -> transform(slice(bits, i + 2, 64), k -> m | k))))"
        )).alias("mask"),
    ).select("a", F.expr("a ^ mask").alias("centre"))
    # Distinct fingerprints around one centre are 2,081 at most.
    least = F.min("a").over(W.partitionBy("centre"))
    return near.withColumn("b", least).where("a != b").select("a", "b").distinct()


def near_duplicates(df: DataFrame, id_column: str = "doc_id", column: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``: the smallest id reachable by links of at most four bits.

    Missing ids take no part in the minimum; a component of missing ids only has none.
    Repeated rows stay.  Documents without words share fingerprint 0.
    """
    prints = stored(
        fingerprints(df.select(F.col(id_column).alias("doc_id"), F.col(column).alias("text")), keep=False), "fingerprints"
    )
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint_groups")
    roots = components(links(groups.select("fp")))
    linked = groups.join(roots, groups.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    named = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = stored(linked.join(named, "root").select("fp", "component_id"), "fingerprint_components")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def _row_key(docs: DataFrame) -> list[Column]:
    """Two columns that tell rows apart: the id, and a hash of all columns."""
    plain = (T.AtomicType,)
    parts = [
        F.col(f"`{f.name}`") if isinstance(f.dataType, plain) else F.col(f"`{f.name}`").cast("string")
        for f in docs.schema.fields
    ]
    return [F.coalesce("doc_id", F.lit(0)).alias("key_id"), F.xxhash64(F.col("doc_id").isNull(), *parts).alias("key_row")]


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component stays, the one with the smallest id, with its columns.

    Missing ids come last.  Of different rows that share the id one stays; rows equal in
    every column are one document.  Documents without words are near copies of each other.  Texts are
    not grouped: only rows that are there twice, found by their keys, are shuffled to keep one.
    """
    keys = _row_key(docs)
    prints = stored(fingerprints(docs.select(*keys, "doc_id", "text"), keep=False), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key_id", "key_row")
    groups = stored(prints.groupBy("fp").agg(F.min(order).alias("best")), "fingerprint_groups")
    roots = components(links(groups.select("fp")))
    linked = groups.join(roots, groups.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    chosen = linked.groupBy("root").agg(F.min("best").alias("best")).select("best.key_id", "best.key_row")
    chosen = stored(chosen, "kept_documents")
    by = ["key_id", "key_row"]
    repeated = prints.groupBy(*by).count().where("count > 1").join(chosen, by, "left_semi").select(*by)
    repeated = stored(repeated, "repeated_documents")
    rows = docs.select(*keys, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(chosen, by, "left_semi")
    if not repeated.isEmpty():
        kept = kept.join(repeated, by, "left_anti").unionByName(kept.join(repeated, by, "left_semi").dropDuplicates(by))
    return kept.select("row.*")
