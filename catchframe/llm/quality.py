"""Quality rules of documents with verdicts of whole hosts.

The counts of a document come from one pass over its text.  Failures of the rules are
then summed per host, rule by rule.  A host's failure rate is shrunk towards the rate of all hosts by
a beta prior whose two parameters are fitted to the hosts themselves (method of
moments), so a host with few documents is judged by the others.  A host is rejected when the lower
bound of the posterior of a rule's rate lies above half of its documents and above twice the prior mean:
most of what it has breaks that rule, and not by chance, and other hosts are not like that.  The verdict is
joined back to its documents.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchframe.llm.common import BLANKS, stored, with_columns_of_text

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_text(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows of three."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode("utf-8").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(text.split("\n"))
    dup = sum(c - 1 for line, c in lines.items() if c > 1 and line.strip(BLANKS))
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        starts = np.fromiter((times[w] > 1 for w in windows), dtype=np.int64, count=len(windows))
        # A word counts when one of the three windows that hold it is repeated.
        covered = np.zeros(n + 1, dtype=np.int64)
        at = np.flatnonzero(starts)
        covered[at] += 1
        np.add.at(covered, at + 3, -1)
        repeated = int((np.cumsum(covered)[:n] > 0).sum())
    return n, chars, symbols, dup, repeated


def features(df: DataFrame, column: str = "text", keep: bool = True) -> DataFrame:
    """All columns of ``df`` and the counts of ``COUNTS`` (long) of the whole text.

    A missing text counts as empty: all counts are 0.  Input columns called like the
    new ones are replaced.  Without ``keep`` the text is left out.
    """
    def make():
        def run(texts):
            counts = np.array([count_text(t) for t in texts], dtype=np.int64).reshape(len(texts), len(COUNTS))
            return [pa.array(counts[:, i]) for i in range(len(COUNTS))]

        return run

    return with_columns_of_text(df, column, make, [T.StructField(c, T.LongType(), False) for c in COUNTS], keep)


def rule_failures() -> dict[str, Column]:
    """Each base rule's failure as a condition on the counts."""
    return {
        "few_words": F.col("n_words") < 50,
        "repetition": F.col("n_repeat_words") * 100 > F.col("n_words") * 50,
    }


def all_failures() -> dict[str, Column]:
    """The base rules, and more symbols than a tenth of the words."""
    return rule_failures() | {"symbols": F.col("n_symbols") * 10 > F.col("n_words")}


def host_failures() -> dict[str, Column]:
    """What hosts are judged by: all rules, and a repeated line for every twenty words."""
    return all_failures() | {"repeated_lines": F.col("n_dup_lines") * 20 > F.col("n_words")}


def _any(broken: dict[str, Column]) -> Column:
    return reduce(or_, broken.values())


# 99 of 100 by the normal approximation of the posterior.
SURE = 2.326


def host_verdicts(counted: DataFrame, host: str, limit: float = 0.5, times: float = 2.0) -> DataFrame:
    """One row per host: documents, failures and shrunk rate of each of ``host_failures``, and ``host_kept``.

    Documents without a host form one host of their own.  A host fails by a rule when its rate is above ``limit`` and
    above ``times`` the prior mean with 99 percent certainty; a table of one host is its own prior, so that host stays.
    """
    broken = host_failures()
    per_host = counted.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("docs"), *[F.count_if(hit).alias(rule) for rule, hit in broken.items()]
    )
    # The prior: mean and variance over hosts of each rule's rate, one row.
    # The sampling variance of the rates is taken off; what is left is the hosts' own.
    moments = []
    for k in broken:
        rate = F.col(k) / F.col("docs")
        moments += [F.avg(rate).alias(f"{k}_m"), F.var_pop(rate).alias(f"{k}_v"),
                    F.avg(1 / F.col("docs")).alias(f"{k}_n")]
    prior = per_host.agg(*moments)
    for k in broken:
        m, v = F.col(f"{k}_m"), F.col(f"{k}_v")
        spread = F.greatest(v - m * (1 - m) * F.col(f"{k}_n"), F.lit(1e-6))
        # alpha + beta, between 1 (rates all over the place) and 10,000 documents.
        size = F.least(F.greatest(m * (1 - m) / spread - 1, F.lit(1.0)), F.lit(1e4))
        prior = prior.withColumn(f"{k}_size", size)
    joined = per_host.crossJoin(F.broadcast(prior))  # one row
    for k in broken:
        size = F.col("docs") + F.col(f"{k}_size")
        rate = (F.col(k) + F.col(f"{k}_m") * F.col(f"{k}_size")) / size
        joined = joined.withColumn(f"{k}_rate", rate)
        lower = F.col(f"{k}_rate") - SURE * F.sqrt(F.col(f"{k}_rate") * (1 - F.col(f"{k}_rate")) / (size + 1))
        joined = joined.withColumn(f"{k}_bad", lower > F.greatest(F.lit(limit), times * F.col(f"{k}_m")))
    kept = ~reduce(or_, [F.col(f"{k}_bad") for k in broken])
    return joined.select("host", "docs", *broken, *[f"{k}_rate" for k in broken], kept.alias("host_kept"))


def verdicts_of(docs: DataFrame, host: str = "source") -> DataFrame:
    """Counts and verdicts per document id: the text is read once, only counts are stored.

    A missing or empty text has no words and fails; documents without a host are one host; a missing id stays missing,
    repeated rows stay, and no documents give no rows.
    """
    counted = stored(
        features(docs.select("doc_id", F.col(host).alias("source"), "text"), keep=False), "quality_counts"
    )
    hosts = stored(host_verdicts(counted, "source").select(F.col("host").alias("__host"), "host_kept"), "host_verdicts")
    done = counted.withColumn("base_failed", _any(rule_failures())).join(hosts, counted.source.eqNullSafe(F.col("__host")), "left")
    kept = ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))
    return done.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The documents that break none of ``all_failures`` and whose host fails none, with the columns they came with.

    One pass over the texts: the rows that break no rule are stored beside their counts, of the others the counts alone.
    The host table is stored too: Spark knows its size and broadcasts it by its own limit, and the texts are not shuffled.
    """
    # Under numbered names no column of the documents clashes with a count.
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text, source = (f"c{docs.columns.index(c)}" for c in ("text", host))
    judged = features(numbered, text).withColumn("broken", _any(all_failures()))
    judged = stored(judged.withColumn(text, F.when(~F.col("broken"), F.col(text))), "counted_documents")
    hosts = stored(host_verdicts(judged, source).where("NOT host_kept").select(F.col("host").alias("__host")), "rejected_hosts")
    kept = judged.where("NOT broken").join(hosts, judged[source].eqNullSafe(F.col("__host")), "left_anti")
    return kept.select(*numbered.columns).toDF(*docs.columns)
