"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Every document has a size in words.  A source's target is its share of all words by
   weight, at most ``cap`` times what it has; the excess is shared again by weight.
2. The documents of a source are put in an order by a keyed hash and cut into blocks of
   that order.  A target is a number of whole passes and a rest; the rest ends inside one
   block, in which a running sum finds the document where it ends.  A source's quota is
   its number of drawn blocks, repeats counted.
3. The quotas are split among the output shards by a binary tree.  At each node the left
   half gets its exact share of the blocks, and the draw of how many of them come from
   which source is multivariate hypergeometric: each source in turn draws from a
   hypergeometric distribution given what the ones before took.
4. The drawn blocks of a source, in their permuted order, are dealt to the shards by these
   counts, so the shards hold disjoint blocks.  What a document gives is the sum over the drawn
   blocks that hold it.  Inside a shard rows are ordered by a hash.

All randomness is a keyed hash, so reruns agree.  A row with a state per source exists per
node of the tree; nothing else is gathered.  Documents are in a window only inside the one block per source
that is cut, and the sums of a source's blocks run over range partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchframe.functions import null_safe_join, running_sums
from catchframe.llm.common import WORD, stored

WEIGHTS = (5, 2, 1)
# A shard has about so many words, and there are so many shards at least.
SHARD_WORDS, LEAST_SHARDS = 1 << 25, 16


@dataclass(frozen=True)
class Mix:
    """Tables of one mix, all in the shared folder: sizes, source plan, last blocks, and the drawn blocks of the shards.

    ``drawn`` has a row per draw: ``source``, ``draw`` (its number in the source), ``block``, ``shard``.
    """

    documents: DataFrame
    sources: DataFrame
    ends: DataFrame
    drawn: DataFrame
    shards: int


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: int = 3, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``weight``, ``target`` from per-source sizes.

    Sources by code point with the missing one last take the weights in turn.  Level L with
    sum(min(cap * size, L * weight)) = total gives all targets at once: sources are sorted
    by the level at which they stop, and the first level that holds all later ones is it.
    The table is one row per source; it is worked on as one array in one row.
    """
    listed = sizes.agg(F.array_sort(F.collect_list(
        F.struct(F.col("source").isNull().alias("none"), F.col("source"), F.col("source_size"))
    )).alias("s"))
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    weighed = listed.select(F.transform("s", lambda x, i: F.struct(
        x.source.alias("source"), x.source_size.alias("source_size"),
        F.element_at(cycle, (i % len(weights) + 1).cast("int")).alias("weight"),
    )).alias("s"))
    total = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x.source_size)
    stops = F.array_sort(F.transform("s", lambda x: F.struct(
        (x.source_size * cap / x.weight).alias("stop"), (x.source_size * cap).alias("most"), x.weight.alias("weight"),
    )))
    start = F.struct(
        F.col("total").cast("double").alias("left"),
        F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x.weight).alias("weights"),
        F.lit(None).cast("double").alias("level"),
    )

    def fill(acc: Column, x: Column) -> Column:
        level = acc.left / acc.weights
        found = acc.level.isNotNull() | (level <= x.stop)
        return F.struct(
            F.when(found, acc.left).otherwise(acc.left - x.most).alias("left"),
            F.when(found, acc.weights).otherwise(acc.weights - x.weight).alias("weights"),
            F.when(found, F.coalesce(acc.level, level)).alias("level"),
        )

    levelled = weighed.withColumn("total", total).withColumn("stops", stops).withColumn("end", F.aggregate("stops", start, fill))
    row = F.col("row")
    target = F.when(
        F.col("end.level").isNull() | (row.source_size * cap / row.weight < F.col("end.level")),
        (row.source_size * cap).cast("double"),
    ).otherwise(F.col("end.left") * row.weight / F.col("end.weights"))
    return levelled.select("end", F.explode("s").alias("row")).select("row.*", target.alias("target"))


def _bind(name: str, value: str, body: str) -> str:
    """SQL text of ``body`` with ``name`` for a value that is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def hypergeometric_sql(u: str, good: str, rest: str, draws: str) -> str:
    """SQL text of a draw by inversion: how many of ``draws`` out of ``good + rest`` are good.

    ``u`` is uniform in (0, 1).  Heights relative to the lowest value follow from the ratio
    of neighbours, over the values within twelve standard deviations of the mode; what lies
    outside has less than 1e-30 of the mass.  The largest height is taken off before exp.
    """
    given = (
        f"named_struct('u', {u}, 'good', double({good}), 'rest', double({rest}), 'draws', double({draws}),"
        f" 'all', double({good}) + double({rest}))"
    )
    mode = "floor((p.draws + 1) * (p.good + 1) / (p.all + 2))"
    reach = (
        "ceil(12 * sqrt(p.draws * p.good * p.rest * greatest(p.all - p.draws, 0D)"
        " / (p.all * p.all * greatest(p.all - 1, 1D)))) + 2"
    )
    span = (
        f"named_struct('low', bigint(greatest({mode} - ({reach}), p.draws - p.rest, 0D)),"
        f" 'high', bigint(least({mode} + ({reach}), p.draws, p.good)))"
    )
    ratio = "ln((p.good - k) * (p.draws - k) / ((k + 1) * (p.rest - p.draws + k + 1)))"
    steps = "sequence(r.low, r.high - 1)"
    mass = (
        f"aggregate({steps}, named_struct('log', 0D, 'top', 0D, 'sum', 1D), (a, k) -> "
        + _bind("now", f"a.log + {ratio}", (
            "named_struct('log', now, 'top', greatest(a.top, now),"
            " 'sum', a.sum * exp(a.top - greatest(a.top, now)) + exp(now - greatest(a.top, now)))"
        )) + ")"
    )
    walk = (
        f"aggregate({steps}, named_struct('log', 0D, 'sum', exp(-m.top), 'n', 0L), (a, k) -> "
        + _bind("now", f"a.log + {ratio}", (
            "named_struct('log', now, 'sum', a.sum + exp(now - m.top), 'n', a.n + bigint(a.sum < p.u * m.sum))"
        )) + ").n"
    )
    drawn = f"CASE WHEN r.low >= r.high THEN r.low ELSE least(r.low + {_bind('m', mass, walk)}, r.high) END"
    sure = "WHEN p.all <= 0 OR p.good <= 0 THEN 0L WHEN p.rest <= 0 THEN bigint(p.draws)"
    return _bind("p", given, f"CASE {sure} ELSE {_bind('r', span, drawn)} END")


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``shard``, ``source``, ``blocks``, ``first``: the tree from all shards down to single ones.

    ``quotas`` has ``source`` and ``quota``.  ``first`` is the number of the source's blocks
    in earlier shards.  Shard sizes differ by one block at most.
    """
    level = quotas.agg(F.array_sort(F.collect_list(
        F.struct(F.col("source").isNull().alias("none"), F.col("source"), F.col("quota").alias("n"))
    )).alias("have")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), "have",
        F.aggregate("have", F.lit(0).cast("long"), lambda a, x: a + x.n).alias("all"),
    )
    u = f"(pmod(xxhash64({seed}, low, high, x.none, x.source), 4503599627370496) + 0.5D) / 4503599627370496D"
    draw = (
        "aggregate(have, named_struct('rest', `all`, 'open', share, 'took', cast(array() AS array<bigint>)), (acc, x) -> "
        + _bind("g", hypergeometric_sql(u, "x.n", "acc.rest - x.n", "acc.open"), (
            "named_struct('rest', acc.rest - x.n, 'open', acc.open - g, 'took', array_append(acc.took, g))"
        )) + ").took"
    )
    width = shards
    while width > 1:
        # A leaf stays; elsewhere the left half gets its shards' part of the node's blocks.
        drawn = (
            level.withColumn("middle", F.expr("(low + high) div 2").cast("int"))
            .withColumn("share", F.expr("if(high - low < 2, `all`, bigint(ceil(`all` * (middle - low) / (high - low))))"))
            .withColumn("took", F.expr(draw))
        )
        halves = F.expr(
            "if(high - low < 2, array(named_struct('low', low, 'high', high, 'have', have, 'all', `all`)), array("
            " named_struct('low', low, 'high', middle, 'have',"
            "  zip_with(have, took, (x, g) -> named_struct('none', x.none, 'source', x.source, 'n', g)), 'all', share),"
            " named_struct('low', middle, 'high', high, 'have',"
            "  zip_with(have, took, (x, g) -> named_struct('none', x.none, 'source', x.source, 'n', x.n - g)), 'all', `all` - share)))"
        )
        level = stored(drawn.select(F.explode(halves).alias("h")).select("h.*"), "splitting_tree")
        width = -(-width // 2)
    flat = level.select(F.col("low").alias("shard"), F.explode("have").alias("h")).select(
        "shard", "h.source", F.col("h.n").alias("blocks")
    )
    earlier = W.partitionBy("source").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return flat.withColumn("first", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)))


def _measured(docs: DataFrame, seed: int, *keep: Column) -> DataFrame:
    """Size of each document and its place in the order of its source; equal rows share a place."""
    place = F.xxhash64(F.lit(seed), "doc_id", "text", "lang").bitwiseAND(F.lit((1 << 62) - 1))
    return docs.select(*keep, "doc_id", "source", word_count(F.col("text")).alias("size"), place.alias("place"))


def _blocked(measured: DataFrame, mix_sources: DataFrame) -> DataFrame:
    """Each document with its source's plan and its block: equal ranges of the place."""
    plan = mix_sources.select(F.col("source").alias("s_source"), "source_size", "target", "passes", "rest", "n_blocks")
    joined = measured.join(plan, measured.source.eqNullSafe(F.col("s_source")), "left").drop("s_source")
    width = F.expr(f"{(1 << 62) - 1} div n_blocks") + 1
    return joined.withColumn("width", width).withColumn("block", F.expr("place div width")).drop("width")


def drawn_blocks(quotas: DataFrame, sources: DataFrame) -> DataFrame:
    """``source``, ``draw``, ``block``, ``shard``: the blocks that the tree gave each shard.

    A pass over a source draws its blocks in order, so draw t is block t modulo the number of blocks.
    """
    n = sources.select("source", "n_blocks")
    ranges = null_safe_join(quotas.where("blocks > 0"), n, ["source"], "left")
    draws = ranges.select("source", "shard", "n_blocks", F.explode(F.expr("sequence(first, first + blocks - 1)")).alias("draw"))
    return draws.select("source", "draw", (F.col("draw") % F.col("n_blocks")).alias("block"), "shard")


def plan_mix(docs: DataFrame, cap: int = 3, shards: int | None = None, block_words: int = 1 << 17, seed: int = 7) -> Mix:
    """What each source gives: passes, the block in which the rest ends, and the blocks that each shard draws.

    Without ``shards`` their number follows the words of the mix.
    """
    sized = stored(_measured(docs, seed), "sized_documents")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0)).cast("long")
    sources = stored(
        source_targets(per_source, cap)
        .withColumn("words", F.round("target").cast("long"))
        .withColumn("passes", passes)
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
        .withColumn("n_blocks", F.greatest(F.ceil(F.col("source_size") / block_words), F.lit(1)).cast("long")),
        "mix_sources",
    )
    if shards is None:
        words = sources.agg(F.sum("words")).first()[0] or 0
        shards = max(-(-words // SHARD_WORDS), LEAST_SHARDS)
    sums = _blocked(sized, sources).groupBy("source", "block").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    starts = running_sums(sums, ["source"], [F.col("block")], {"upto": "words"}).withColumn("start", F.col("upto") - F.col("words"))
    # Blocks before the one in which the rest ends are drawn whole in the last pass.
    ends = stored(
        starts.where((F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest")))
        .groupBy("source").agg(F.min(F.struct("block", (F.col("rest") - F.col("start")).alias("open"))).alias("e"))
        .select(F.col("source").alias("e_source"), F.col("e.block").alias("end_block"), F.col("e.open").alias("open")),
        "mix_ends",
    )
    quotas = sources.join(ends, sources.source.eqNullSafe(F.col("e_source")), "left").select(
        "source", (F.col("passes") * F.col("n_blocks") + F.coalesce(F.col("end_block") + 1, F.lit(0))).alias("quota")
    )
    drawn = stored(drawn_blocks(split_quotas(quotas, shards, seed), sources), "mix_draws")
    return Mix(sized, sources, ends, drawn, shards)


def with_parts(measured: DataFrame, mix: Mix) -> DataFrame:
    """Measured documents with ``part``, their words in the draw in which their source's rest ends; missing elsewhere.

    Only documents of the one block per source that is cut need a running sum.
    """
    blocked = _blocked(measured, mix.sources)
    placed = blocked.join(mix.ends, blocked.source.eqNullSafe(F.col("e_source")), "left").drop("e_source")
    at_end = F.coalesce(F.col("block") == F.col("end_block"), F.lit(False))
    order = W.partitionBy("source", "block").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    cut = placed.where(at_end).withColumn("earlier", F.coalesce(F.sum("size").over(order), F.lit(0))).withColumn(
        "part", F.greatest(F.least(F.col("size"), F.col("open") - F.col("earlier")), F.lit(0))
    ).drop("earlier")
    whole = placed.where(~at_end).withColumn("part", F.lit(None).cast("long"))
    return cut.unionByName(whole).drop("open", "end_block", "rest", "passes")


def taken_words(measured: DataFrame, mix: Mix) -> DataFrame:
    """Measured documents with ``part`` and ``taken``: their words in all draws of their block."""
    times = mix.drawn.groupBy("source", "block").agg(F.count(F.lit(1)).alias("times"))
    found = null_safe_join(with_parts(measured, mix), stored(times, "mix_times"), ["source", "block"], "left")
    n = F.coalesce("times", F.lit(0))
    taken = F.when(n == 0, F.lit(0)).when(F.col("part").isNull(), n * F.col("size")).otherwise((n - 1) * F.col("size") + F.col("part"))
    return found.withColumn("taken", taken.cast("long")).drop("times")


def takes(measured: DataFrame, mix: Mix, seed: int = 7, whole: bool = False) -> DataFrame:
    """One row per take of a document, with ``words``, ``shard`` and ``position`` in the shard.

    A document is taken by every draw of its block; the last draw of a source takes ``part`` of
    a document.  With ``whole`` it takes the document as such, or not, whichever is nearer.
    """
    parts = with_parts(measured, mix)
    if whole:
        near = F.when(2 * F.col("part") >= F.greatest(F.col("size"), F.lit(1)), F.col("size")).otherwise(F.lit(0))
        parts = parts.withColumn("part", F.when(F.col("part").isNotNull(), near))
    last = stored(mix.drawn.groupBy("source").agg(F.max("draw").alias("last_draw")), "last_draws")
    found = null_safe_join(parts.where("size > 0"), null_safe_join(mix.drawn, last, ["source"], "left"), ["source", "block"], "inner")
    cut = F.col("part").isNotNull() & (F.col("draw") == F.col("last_draw"))
    words = F.when(cut, F.col("part")).otherwise(F.col("size"))
    return found.withColumn("words", words).where("words > 0").drop("last_draw").withColumn(
        "position", F.xxhash64(F.lit(seed), "shard", "place", "draw")
    )


def mixed(
    docs: DataFrame, cap: int = 3, shards: int | None = None, block_words: int = 1 << 17, seed: int = 7, whole: bool = False
) -> DataFrame:
    """The documents of the mix: each as often as it is taken, the last one of a source cut to its words.

    With ``whole`` no text is cut: the last document of a source is taken whole or not at all,
    whichever is nearer to the target.

    Columns and their order are those of ``docs``; the rows come in one partition per shard
    and in the shard's shuffled order.  ``n_chars``, where there is one, follows a cut text.  Texts without
    words are not taken; missing sources are one source; a repeated row is a document of its own.
    """
    mix = plan_mix(docs, cap, shards, block_words, seed)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    drawn = takes(_measured(docs, seed, row), mix, seed, whole)
    # A piece ends where a word ends, so the first pieces are the first words with their blanks.
    pieces = F.split("row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    first = F.array_join(F.slice(pieces, F.lit(1), F.greatest(F.col("words"), F.lit(1)).cast("int")), "")
    is_cut = F.col("words") < F.col("size")
    changed = F.col("row").withField("text", F.when(is_cut, first).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withField("n_chars", F.when(is_cut, F.length(first).cast(kind)).otherwise(F.col("row.n_chars")))
    out = drawn.select("shard", "position", changed.alias("row"))
    return out.repartitionById(mix.shards, F.col("shard").cast("int")).sortWithinPartitions("position").select("row.*")


def mix_report(docs: DataFrame, cap: int = 3, shards: int | None = None, block_words: int = 1 << 17, seed: int = 7) -> DataFrame:
    """Per document ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``, and ``last_pass``, its part of the cut draw.

    A missing text or a text of blanks has size 0 and gives nothing.  Missing sources are
    one source, the last.  A repeated row is a document of its own; no documents give no rows.
    """
    mix = plan_mix(docs, cap, shards, block_words, seed)
    return taken_words(mix.documents, mix).select(
        "doc_id", "size", "source_size", "target", "taken", F.coalesce("part", F.lit(0)).alias("last_pass")
    )
