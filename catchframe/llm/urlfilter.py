"""URL filter: rules by host and path, and a character language-model ratio for the rest.

1. A rule fits its host and all subdomains if the path starts with the rule's; the longest one that
   fits decides.  URLs that a rule decides are the accepted and the rejected ones.
2. One character model is learned from each of the two, all URLs of them but the calibration fold.  The
   models are Markov models of variable order: the probability of a character after a context of up to
   ``order`` characters is interpolated with that after the context without its first one, by
   Witten and Bell's weights, (n(c after x) + t(x) * p(c after shorter x)) / (n(x) + t(x)), where t(x)
   is the number of different characters seen after x.  A context that was never seen has weight
   nothing, so the order falls back to what the data hold; the last resort is uniform.
3. A URL's score is the sum of log ratios over its characters and its end, over their number.
4. The threshold is calibrated on the fold that the models did not see: the one with the least sum of
   both error rates; of several the one nearest to 0, where both models fit a URL equally well.

Models are tables: a gram (context and character) with its log ratio, whatever their number.  Grams are
counted with partial sums before the shuffle, and each different gram is valued once.  Log ratios are
integers of a millionth, so that sums do not depend on their order and reruns agree.  No join sends a
table to the driver: Spark takes the grams of all URLs to be as small as the stored URLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catchframe.llm.common import stored

RULES = (
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
)
ORDER = 5
FOLDS = 5
START, END = "\x02", "\x03"
# Code points: the uniform model below all others.
SYMBOLS = 1_114_112
SCALE = 1_000_000
BIN = 1000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL, both empty where it is missing or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """``rule`` and ``verdict`` of the longest rule that fits, missing without one; ``rules`` is a short list."""
    found = F
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(slash + start)
        found = found.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
    return found.otherwise(F.lit(None))


def grams(text: Column, order: int = ORDER) -> Column:
    """Each character of the text and its end, behind the ``order`` characters before it."""
    chars = F.concat(F.array_repeat(F.lit(START), order), F.split(text, ""), F.array(F.lit(END)))
    # Splitting an empty text gives one empty character.
    chars = F.filter(chars, lambda c: c != "")
    return F.transform(
        F.sequence(F.lit(1), F.size(chars) - order), lambda i: F.array_join(F.slice(chars, i, F.lit(order + 1)), "")
    )


def merged(left: DataFrame, right: DataFrame, on: str | Column) -> DataFrame:
    """Inner join of sorted sides, never by a broadcast, which the driver would have to hold.

    Stored tables are estimated by their compressed files, and grams exploded from them as no larger,
    though a URL has some tens of them.
    """
    return left.join(right.hint("merge"), on)


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram`` and ``ratio`` (millionths) from ``gram``, ``good`` and ``bad``: how often each class has the gram.

    From the shortest context up, each order's table is one row per different gram of that length.
    """
    lower = None
    for k in range(order + 1):
        events = counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("gram")).agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad")
        ).withColumn("context", F.substring("gram", 1, k))
        # Rows of one context are its different next characters.
        of = W.partitionBy("context")
        sums = []
        for c in ("good", "bad"):
            sums += [F.sum(c).over(of).alias(f"n_{c}"), F.sum((F.col(c) > 0).cast("long")).over(of).alias(f"t_{c}")]
        events = events.select("gram", "good", "bad", *sums)
        if lower is None:
            events = events.withColumns({f"q_{c}": F.lit(1.0 / SYMBOLS) for c in ("good", "bad")})
        else:
            shorter = lower.select(F.col("gram").alias("short"), F.col("p_good").alias("q_good"), F.col("p_bad").alias("q_bad"))
            events = merged(events, shorter, F.substring("gram", 2, k) == F.col("short"))
        lower = stored(events.select("gram", *[
            F.when(F.col(f"n_{c}") == 0, F.col(f"q_{c}")).otherwise(
                (F.col(c) + F.col(f"t_{c}") * F.col(f"q_{c}")) / (F.col(f"n_{c}") + F.col(f"t_{c}"))
            ).alias(f"p_{c}")
            for c in ("good", "bad")
        ]), f"url_grams_{k}")
    return stored(
        lower.select("gram", F.round((F.ln("p_good") - F.ln("p_bad")) * SCALE).cast("long").alias("ratio")), "url_ratios"
    )


def calibrated(scored: DataFrame) -> int:
    """The threshold, in bins of scores, for ``bin`` and ``verdict`` of held-out URLs; 0 if a class has none.

    Scores are bounded by the model's smallest probability, so the bins are some thousands
    whatever the number of URLs; one row per bin is looked at as a whole.
    """
    bins = scored.groupBy("bin").agg(
        F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad")
    )
    # A threshold at a bin lets the bin pass; the one above all bins stops everything.
    edges = bins.unionByName(bins.select((F.max("bin") + 1).alias("bin"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad")))
    below = W.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    errors = edges.where("bin IS NOT NULL").select(
        "bin", F.coalesce(F.sum("good").over(below), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("bad").over(below), F.lit(0)).alias("stopped"),
        F.sum("good").over(W.partitionBy()).alias("good"), F.sum("bad").over(W.partitionBy()).alias("bad"),
    ).where("good > 0 AND bad > 0")
    cost = errors.select("bin", (F.col("lost") / F.col("good") + (F.col("bad") - F.col("stopped")) / F.col("bad")).alias("cost"))
    best = cost.withColumn("least", F.min("cost").over(W.partitionBy())).where("cost = least")
    row = best.agg(F.min_by("bin", F.struct(F.abs("bin"), "bin")).alias("t")).first()
    return row.t if row.t is not None else 0


def fold(url: Column) -> Column:
    """The fold of a URL, from 0; equal URLs share one."""
    return F.pmod(F.crc32(F.coalesce(url, F.lit("")).cast("binary")), F.lit(FOLDS))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_column: str = "page_id", column: str = "url", order: int = ORDER
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` and ``threshold`` of every row.

    ``score`` is the mean log ratio of the URL's characters and ``threshold`` the least one that is allowed by
    the models.  A missing URL counts as empty and is judged by its end alone; a missing id stays
    missing, repeated rows stay.  Without accepted or without rejected URLs in the calibration fold
    the threshold is 0; a model that saw nothing is uniform.  No rows give no rows.
    """
    host, path = host_and_path(F.col(column))
    found = rule_of(F.col("host"), F.col("path"), rules)
    rows = stored(
        pages.select(F.col(id_column).alias("page_id"), F.col(column).alias("url"), host.alias("host"), path.alias("path"))
        .withColumn("found", found).withColumns({"row": F.monotonically_increasing_id(), "fold": fold(F.col("url"))}),
        "url_rows",
    )
    text = F.coalesce("url", F.lit(""))
    places = rows.select("row", F.col("found.verdict").alias("verdict"), "fold", F.explode(grams(text, order)).alias("gram"))
    learn = F.col("fold") != 0
    counts = stored(places.groupBy("gram").agg(
        F.count_if(learn & (F.col("verdict") == "allow")).alias("good"),
        F.count_if(learn & (F.col("verdict") == "block")).alias("bad"),
    ), "url_counts")
    ratios = log_ratios(counts, order)
    sums = merged(places.select("row", "gram"), ratios, "gram").groupBy("row").agg(
        F.sum("ratio").alias("ratio"), F.count(F.lit(1)).alias("n")
    )
    millionths = F.floor(F.col("ratio") / F.col("n"))
    scores = sums.select("row", millionths.cast("long").alias("millionths"), F.floor(millionths / BIN).cast("long").alias("bin"))
    scored = stored(merged(rows, scores, "row"), "url_scores")
    least = calibrated(scored.where("fold = 0 AND found IS NOT NULL").select("bin", "found.verdict"))
    by_model = F.when(F.col("bin") >= least, "allow").otherwise("block")
    return scored.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", by_model).alias("verdict"),
        (F.col("millionths") / SCALE).alias("score"), F.lit(least * BIN / SCALE).alias("threshold"), by_model.alias("model_verdict"), "fold",
    )
