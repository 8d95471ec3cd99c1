"""Merkle manifest of a data set: a content-addressed DAG, and proofs by descent from its root.

1. A row's leaf is the digest of its fields.  In each group (source) leaves are ranked by id; every
   ``FAN`` consecutive nodes become the digest of their digests until one is left, the subroot.
   Subroots in the order of the groups give the root in the same way.
2. A node is kept as a record: its digest and the digests of its children.  Records are addressed by
   content alone, so equal subtrees are one record.
3. Requests name leaves by group and rank.  The digits of a rank in base ``FAN`` are the way from the
   subroot to the leaf, those of the group's number the way from the root to the subroot.  The
   descent takes all requests down together: at each height the nodes that a request goes through
   look up their children by digest, go on to the chosen ones and collect the siblings to the
   left and right of each.  Segments come root first; reversed they are the path of a proof.

A node occurs once in a descent however many requests go through it, so the root is no hot key.
Ranks come from range partitions, so a group may hold any part of all rows.  The paths of leaves are
unfolded in the last step only and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions import ranked
from catchframe.llm.common import id_remainder, stored

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The tree whose leaves are the subroots.
TOP = -1
NODE = "tree long, n long, digest string, size long, children array<string>, height int"


@dataclass(frozen=True)
class Manifest:
    """Tables of a manifest, all in the shared folder.

    ``leaves``: the rows with ``tree`` (number of the group), ``n`` (rank) and ``leaf``.  ``groups``: ``tree``, the
    group's value, ``size``, ``height`` and ``subroot``.  ``records``: ``height``, ``digest``, ``children``.
    ``root`` is the digest of everything, ``height`` the height of the tree of subroots.
    """

    leaves: DataFrame
    groups: DataFrame
    records: DataFrame
    root: str
    height: int


def digest_of(fields: Sequence[Column]) -> Column:
    """Hex SHA-256 of the fields: ``-`` for a missing one, else its length in bytes, ``:`` and its value."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.when(field.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def height_of(size: Column) -> Column:
    """How often ``FAN`` nodes become one until one is left of ``size``."""
    # Powers of a small base are exact as longs; 16 ** 15 is the last one below 2 ** 63.
    powers = F.array(*[F.lit(FAN ** h) for h in range(16)])
    return F.size(F.filter(powers, lambda p: p < size))


def _grow(nodes: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Node tables of height 1 and more over ``tree``, ``n``, ``digest``, ``size`` (nodes of that height in the tree)."""
    levels = []
    for h in range(1, height + 1):
        runs = nodes.where("size > 1").groupBy("tree", F.expr(f"n div {FAN}").alias("up"), "size").agg(
            F.array_sort(F.collect_list(F.struct("n", "digest"))).alias("run")
        )
        children = F.transform("run", lambda x: x.digest)
        nodes = stored(runs.select(
            "tree", F.col("up").alias("n"), F.sha2(F.array_join(children, ""), 256).alias("digest"),
            F.ceil(F.col("size") / FAN).cast("long").alias("size"), children.alias("children"), F.lit(h).alias("height"),
        ), f"{name}_{h}")
        levels.append(nodes)
    return levels


def build(rows: DataFrame, group: str, order: str) -> Manifest:
    """Manifest of ``rows``, which have a column ``leaf`` besides the group and the order.

    A missing group is a group, the first; a missing id comes first; rows that share the id go by
    their leaf.  A repeated row is a leaf of its own.  Without rows the root is the digest of no bytes.
    """
    spark = rows.sparkSession
    spread = rows.withColumn("__row", F.monotonically_increasing_id())
    placed = ranked(spread, [group], [F.col(f"`{order}`"), F.col("leaf"), F.col("__row")], "n").drop("__row")
    sizes = stored(rows.groupBy(group).agg(F.count(F.lit(1)).alias("size")), "merkle_sizes")
    numbered = stored(
        ranked(sizes, [], [F.col(f"`{group}`")], "tree").withColumn("height", height_of(F.col("size"))), "merkle_groups"
    )
    small = numbered.select(F.col(f"`{group}`").alias("__group"), "tree", "size", "height")
    leaves = stored(
        placed.join(small, placed[group].eqNullSafe(F.col("__group")), "left").drop("__group"), "merkle_leaves"
    )
    most = numbered.agg(F.max("height").alias("h"), F.count(F.lit(1)).alias("n")).select("h", "n", height_of(F.col("n")).alias("top")).first()
    if not most.n:
        nodes = spark.createDataFrame([], NODE)
        empty = spark.range(1).select(F.sha2(F.lit(""), 256).alias("d")).first().d
        return Manifest(leaves, numbered.withColumn("subroot", F.lit("")), nodes.select("height", "digest", "children"), empty, 0)
    levels = _grow(leaves.select("tree", "n", F.col("leaf").alias("digest"), "size"), most.h, "merkle_level")
    subroots = leaves.where("height = 0").select("tree", F.col("leaf").alias("subroot"))
    for level in levels:
        subroots = subroots.unionByName(level.where("size = 1").select("tree", F.col("digest").alias("subroot")))
    groups = stored(numbered.join(subroots, "tree"), "merkle_subroots")
    tops = groups.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("n"), F.col("subroot").alias("digest"), F.lit(most.n).alias("size"))
    upper = _grow(tops, most.top, "merkle_top")
    last = upper[-1] if upper else tops
    root = last.where("size = 1").first().digest
    # Records of the upper tree lie above those of all groups.
    records = spark.createDataFrame([], NODE).select("height", "digest", "children")
    for h, level in enumerate(levels + upper, start=1):
        records = records.unionByName(level.select(F.lit(h).alias("height"), "digest", "children"))
    return Manifest(leaves, groups, records, root, most.top)


def _wanted(requests: DataFrame, height: int, name: str) -> list[DataFrame]:
    """Per height the nodes that requests go through, with their chosen digits as bits of ``digits``."""
    out, below = [], requests.select("tree", "n").distinct()
    for h in range(1, height + 1):
        below = stored(below.groupBy("tree", F.expr(f"n div {FAN}").alias("up")).agg(
            F.bit_or(F.expr(f"shiftleft(1, cast(n % {FAN} AS int))")).alias("digits")
        ).withColumnRenamed("up", "n"), f"{name}_{h}")
        out.append(below)
    return out


def _with_children(frontier: DataFrame, records: DataFrame, height: int) -> DataFrame:
    """The frontier's nodes with the children that the records of the height hold for their digests."""
    known = records.where(F.col("height") == height).select("digest", "children").dropDuplicates(["digest"])
    lost = F.raise_error(F.concat(F.lit("no record of node "), F.col("digest"))).cast("array<string>")
    return frontier.join(known, "digest", "left").withColumn("children", F.coalesce("children", lost))


def _segment(children: str, digit: str) -> str:
    """SQL text of the siblings to the left and to the right of a child, as one text each."""
    return (
        f"named_struct('before', array_join(slice({children}, 1, {digit}), ''),"
        f" 'after', array_join(slice({children}, {digit} + 2, {FAN}), ''))"
    )


def _step(frontier: DataFrame, wanted: DataFrame, records: DataFrame, height: int) -> DataFrame:
    """From nodes to those of their children that requests go through."""
    found = _with_children(frontier.join(wanted, ["tree", "n"]), records, height)
    digit = F.explode(F.expr(f"filter(sequence(0, {FAN - 1}), d -> (shiftright(digits, d) & 1) = 1)")).alias("d")
    return found.select("*", digit).select(
        "tree", F.expr(f"n * {FAN} + d").alias("n"), F.expr("element_at(children, d + 1)").alias("digest"),
        F.expr(f"array_append(path, {_segment('children', 'd')})").alias("path"),
    )


def descend(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """The requests with ``digest``, the leaf that is reached, and ``path``, the siblings from the leaf to the root.

    ``requests`` has ``tree`` and ``n``, each pair once, and any other columns.  ``path`` is an array of ``before`` and
    ``after``: the digests left and right of the node in its run, in one text each.  A digest that the
    records do not hold fails the job; a request beyond a group's leaves gives no row.
    """
    columns = [c for c in requests.columns if c not in ("tree", "n")]
    heights = manifest.groups.select("tree", "height", "size")
    tallest = heights.agg(F.max("height")).first()[0]
    if tallest is None:
        return requests.select("*", F.lit("").alias("digest"), F.expr("cast(array() AS array<struct<before:string,after:string>>)").alias("path")).where("false")
    known = requests.join(heights, "tree").where("n >= 0 AND n < size").drop("size", "height")
    wanted = _wanted(known, tallest, "merkle_wanted")
    asked = known.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("n")).distinct()
    frontier = requests.sparkSession.range(1).select(
        F.lit(TOP).cast("long").alias("tree"), F.lit(0).cast("long").alias("n"), F.lit(manifest.root).alias("digest"),
        F.expr("cast(array() AS array<struct<before:string,after:string>>)").alias("path"),
    )
    above = _wanted(asked, manifest.height, "merkle_wanted_top")
    for h in range(manifest.height, 0, -1):
        frontier = stored(_step(frontier, above[h - 1], manifest.records, tallest + h), "merkle_frontier")
    entered = frontier.select(F.col("n").alias("tree"), F.lit(0).cast("long").alias("n"), "digest", "path").join(
        heights.select("tree", "height"), "tree"
    )
    none = entered.where("false").drop("height")
    frontier = none
    for h in range(tallest, 1, -1):
        here = frontier.unionByName(entered.where(F.col("height") == h).drop("height"))
        frontier = stored(_step(here, wanted[h - 1], manifest.records, h), "merkle_frontier")
    # Leaves: one run of requests per lowest node, so that a path is unfolded beside its requests.
    payload = F.struct(F.expr(f"cast(n % {FAN} AS int)").alias("d"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    runs = known.groupBy("tree", F.expr(f"n div {FAN}").alias("up")).agg(F.collect_list(payload).alias("run")).withColumnRenamed("up", "n")
    lowest = frontier.unionByName(entered.where("height = 1").drop("height")) if tallest else none
    single = entered.where("height = 0").drop("height").join(runs, ["tree", "n"]).select("*", F.expr("cast(null AS array<string>)").alias("children"))
    if tallest:
        several = _with_children(lowest.join(runs, ["tree", "n"]), manifest.records, 1)
        single = single.unionByName(several)
    out = single.select("tree", F.col("n").alias("up"), "digest", "path", "children", F.explode("run").alias("x"))
    at = "x.d"
    return out.select(
        "tree", F.expr(f"if(children IS NULL, up, up * {FAN} + {at})").alias("n"), "x.row.*",
        F.expr(f"if(children IS NULL, digest, element_at(children, {at} + 1))").alias("digest"),
        F.expr(f"reverse(if(children IS NULL, path, array_append(path, {_segment('children', at)})))").alias("path"),
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda digest, p: F.sha2(F.concat(p.before, digest, p.after), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf's run up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p.before, p.after)), ""), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def tamper_report(docs: DataFrame) -> DataFrame:
    """Per document its leaf, subroot, root, the digest of its proof, and what its tampered leaf folds to.

    Where 5 divides the crc32 of the id, A-Z in the text becomes lower case; a missing id or text stays.
    Missing fields are ``-``; empty, blank and very long texts are texts like others.  A repeated row is a
    leaf of its own; rows that share the id go by their leaf.  No documents give no rows.
    """
    fields = docs.select("doc_id", "source", "lang", "n_chars", "text")
    changed = [lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in FIELDS]
    hit = id_remainder("doc_id", 5) == 0
    rows = fields.select(
        "doc_id", "source", digest_of([F.col(c) for c in FIELDS]).alias("leaf"),
        F.when(hit, digest_of(changed)).alias("tampered"),
    )
    rows = stored(rows, "merkle_digests")
    manifest = build(rows, "source", "doc_id")
    named = manifest.groups.select("tree", "subroot")
    found = descend(manifest, manifest.leaves.select("tree", "n", "doc_id", "leaf", "tampered"))
    done = found.select(
        "doc_id", "leaf", "tree", F.lit(manifest.root).alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    )
    return done.join(named, "tree").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
