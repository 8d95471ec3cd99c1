"""Conversation structure repair.

Turns are put in order, faults of rows are found (blank, a repeated turn, cut off), and the cheapest edits
give a conversation of an optional system turn and pairs of user and assistant: see ``auction``.

A conversation may have any number of rows.  Ranks come from range partitions; repeated turns are found by a
digest's first place, with partial minima before the shuffle.  For the auction a conversation is
cut into parts of at most ``PART`` rows; a part's result is the cheapest way from each of four
states to each other one, and parts are joined ``WIDE`` at a time, level by level.  Only the digest of the
repaired text goes through a conversation's rows in order; it streams over sorted rows and
holds one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.functions import null_safe_join, ranked
from catchframe.llm import auction
from catchframe.llm.common import BLANKS, map_arrow, stored

PART = 256
WIDE = 64
WAY = "struct<cost:long,audit:string>"
PLAN = "key long, cost long, audit string, illegal long"
MERGED = f"key long, up long, part struct<seg:long,first:string,last:string,illegal:long,ways:array<{WAY}>>"


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` after damage by the crc32 of ``conv_id:turn``, modulo 20.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes it a user's.
    A missing value is one space in the key, the role and the text.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    hit = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce("text", space)
    return turns.select(
        "conv_id", "turn", F.when(hit == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(hit == 1, "").when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(hit == 3, F.array(F.lit(0), F.lit(1))).when(hit == 0, F.expr("cast(array() AS array<int>)")).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def in_turn(rows: DataFrame) -> DataFrame:
    """``rows`` with ``key``, a number of the conversation, and ``place`` in it, from 0.

    Turns ascend, missing ones first; equal turns go by role and text.
    """
    ids = stored(
        ranked(rows.select("conv_id").distinct(), [], [F.col("conv_id")], "key"), "conversation_keys"
    )
    placed = ranked(
        rows.withColumn("__row", F.monotonically_increasing_id()), ["conv_id"],
        [F.col("turn"), F.col("role"), F.col("text"), F.col("__row")], "place",
    ).drop("__row")
    return null_safe_join(placed, ids, ["conv_id"], "left")


def faults(rows: DataFrame) -> DataFrame:
    """``key``, ``place``, ``turn``, ``initial`` (s, u, a or x) and ``fault`` of each row of ``in_turn``; texts are left out.

    The first that holds counts: blank, repeated (role and text of an earlier row), cut off (no ``.``, ``!``
    or ``?`` at the end), else fine.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    slim = stored(rows.select(
        "key", "place", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.when(bare == "", auction.BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), auction.FINE).otherwise(auction.SHORT).alias("fault"),
        F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("digest"),
    ), "turn_faults")
    # Only digests that occur again have a first place to compare with.
    firsts = slim.groupBy("key", "digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    fault = F.when((F.col("fault") != auction.BLANK) & (F.col("place") > F.col("first")), auction.COPY).otherwise(F.col("fault"))
    return slim.join(firsts.drop("n"), ["key", "digest"], "left").withColumn("fault", fault).drop("digest", "first")


def _parts(coded: DataFrame, size: int) -> DataFrame:
    """One row per part of a conversation: ``key``, ``seg``, ``initials``, ``faults``."""
    cells = F.array_sort(F.collect_list(F.struct("place", "initial", "fault")))
    return coded.groupBy("key", F.expr(f"place div {size}").alias("seg")).agg(cells.alias("c")).select(
        "key", "seg", F.array_join(F.transform("c", lambda x: x.initial), "").alias("initials"),
        F.array_join(F.transform("c", lambda x: x.fault), "").alias("faults"),
    )


def illegal_pairs(initials: str) -> int:
    """Neighbours that are not system and user, user and assistant, or assistant and user."""
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


def _table(schema: T.StructType, rows: list[dict]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    return pa.RecordBatch.from_pylist(rows, to_arrow_schema(schema))


def _cells(ways: list) -> list:
    return [None if w is None else {"cost": w[0], "audit": w[1]} for w in ways]


def _ways(cells: list) -> list:
    return [None if c is None else (c["cost"], c["audit"]) for c in cells]


def plans(coded: DataFrame, size: int = PART, wide: int = WIDE) -> DataFrame:
    """``key``, ``cost``, ``audit``, ``illegal`` of each conversation of ``faults``' rows.

    Conversations of more than ``size`` rows are cut into parts, which are joined ``wide`` at a time.
    """
    spark = coded.sparkSession
    plan, merged = T._parse_datatype_string(PLAN), T._parse_datatype_string(MERGED)
    parts = stored(_parts(coded, size), "turn_parts")
    longer = stored(parts.groupBy("key").agg(F.max("seg").alias("top")).where("top > 0"), "long_conversations")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                cost, audit = auction.repair(row["initials"], row["faults"])
                out.append({"key": row["key"], "cost": cost, "audit": audit, "illegal": illegal_pairs(row["initials"])})
            yield _table(plan, out)

    short = map_arrow(parts.join(longer, "key", "left_anti").drop("seg"), whole, plan)
    most = longer.agg(F.max("top")).first()[0]
    if most is None:
        return short

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                a = row["initials"]
                part = {"seg": row["seg"], "first": a[0], "last": a[-1], "illegal": illegal_pairs(a),
                        "ways": _cells(auction.crossings(a, row["faults"]))}
                out.append({"key": row["key"], "up": row["seg"] // wide, "part": part})
            yield _table(merged, out)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                run = row["run"]
                total, ways = dict(run[0]), _ways(run[0]["ways"])
                for part in run[1:]:
                    ways = auction.joined(ways, _ways(part["ways"]))
                    total["illegal"] += part["illegal"] + illegal_pairs(total["last"] + part["first"])
                    total["last"] = part["last"]
                total |= {"seg": row["up"], "ways": _cells(ways)}
                out.append({"key": row["key"], "up": row["up"] // wide, "part": total})
            yield _table(merged, out)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                cost, audit = auction.closed(_ways(row["part"]["ways"]))
                out.append({"key": row["key"], "cost": cost, "audit": audit, "illegal": row["part"]["illegal"]})
            yield _table(plan, out)

    level = stored(map_arrow(parts.join(longer, "key", "left_semi"), cross, merged), "turn_crossings")
    while most > 0:
        runs = level.groupBy("key", "up").agg(F.array_sort(F.collect_list("part")).alias("run"))
        level = stored(map_arrow(runs, merge, merged), "turn_crossings")
        most //= wide
    return short.unionByName(map_arrow(level, close, plan))


class Rebuilt:
    """The repaired rows of one conversation, as its rows come by in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, auction.EMPTY

    def _turn(self) -> str:
        self.state = auction.NEXT[self.state]
        return auction.ROLES[self.state]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._turn(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            if role[:1] == "s":
                self.state = auction.SYSTEM
            else:
                self._turn()
            yield role, text
        elif edit == "R":
            yield self._turn(), text


def _streamed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows of ``in_turn`` by conversation and place, each conversation's edits before its first row."""
    texts = rows.select("key", "place", "role", "text", F.lit(None).cast("string").alias("audit"))
    heads = plan.select("key", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    return texts.unionByName(heads).repartition("key").sortWithinPartitions("key", "place")


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``key``, ``place`` from 0, ``role``, ``text``: the repaired conversations, row by row."""
    schema = T._parse_datatype_string("key long, place long, role string, text string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, n = None, None, 0
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["place"] < 0:
                    for turn in now.inserted() if now else ():
                        out.append((key, n, *turn))
                        n += 1
                    key, now, n = row["key"], Rebuilt(row["audit"]), 0
                else:
                    for turn in now.row(row["role"], row["text"]):
                        out.append((key, n, *turn))
                        n += 1
            yield _table(schema, [dict(zip(schema.names, x)) for x in out])
        yield _table(schema, [dict(zip(schema.names, (key, n + i, *turn))) for i, turn in enumerate(now.inserted() if now else ())])

    return map_arrow(_streamed(rows, plan), run, schema)


def repaired_digests(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``key`` and ``repaired_sha256``, the digest of the lines ``role:text`` of the repaired conversation."""
    names = ["key", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, digest, n = None, None, None, 0

        def add(turns):
            nonlocal n
            for role, text in turns:
                digest.update(f"{chr(10) if n else ''}{role}:{text}".encode())
                n += 1

        for batch in batches:
            keys, digests = [], []
            for k, place, role, text, audit in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if place < 0:
                    if now:
                        add(now.inserted())
                        keys.append(key)
                        digests.append(digest.hexdigest())
                    key, now, digest, n = k, Rebuilt(audit), hashlib.sha256(), 0
                else:
                    add(now.row(role, text))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(digests, pa.string())], names=names)
        if now:
            add(now.inserted())
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([digest.hexdigest()])], names=names)

    return map_arrow(_streamed(rows, plan), run, "key long, repaired_sha256 string")


def missing_turns(coded: DataFrame) -> Column:
    """Turns between the first and the last that do not occur; missing ones do not count."""
    return F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long")


def repair_report(turns: DataFrame) -> DataFrame:
    """Per conversation: gaps, blank, duplicate and truncated rows, illegal neighbours, cost, edits, digest of the repaired text.

    Every ``conv_id`` gives one row, a missing one too.  A conversation without rows after damage has zeros, no edits and
    the digest of no bytes.  A missing role or text is one space, so such a text is blank.  Missing turns
    come first and are no gaps; equal turns go by role and text; repeated rows are faults like
    others.  A role that begins with another letter than s, u, a is changed or deleted.  No rows give no rows.
    """
    asked = turns.select("conv_id").distinct()
    rows = stored(in_turn(damaged(turns.select("conv_id", "turn", "role", "text"))), "turns")
    coded = stored(faults(rows), "coded_turns")
    counts = coded.groupBy("key").agg(
        missing_turns(coded).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(n) for n, f in (("blank", auction.BLANK), ("duplicate", auction.COPY), ("truncated", auction.SHORT))],
    )
    plan = stored(plans(coded), "turn_plans")
    ids = rows.select("conv_id", "key").distinct()
    done = ids.join(counts, "key").join(plan, "key").join(repaired_digests(rows, plan), "key").drop("key")
    longs = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return null_safe_join(asked, done, ["conv_id"], "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
