"""Hot keys: a group with a large part of all rows is split, and results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catchframe.functions import stored
from catchframe.operators import composition, indices, overview


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, n=60_000):
    """A third of the rows in one group, the rest in 200 groups; made in several map tasks."""
    i = F.col("id")
    return spark.range(0, n, 1, 6).select(
        i.alias("ord"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), (i % 200).cast("string"))).alias("group"),
        (i % 2 + 1).cast("int").alias("count"),
        F.lit("TBB").alias("gear_group"),
        F.lit("Landings").alias("category"),
        (i % 10 + 1).cast("double").alias("caton"),
        ((i % 64) / F.lit(64.0)).alias("perc"),
    )


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().toString().split("Initial Plan")[0]


def test_hot_raising_group_is_split(spark, no_broadcast):
    df = skewed(spark)
    out = composition.raise_percent(df)
    assert "skew=true" in final_plan(out)
    want = {
        r["group"]: r["n"] / r["d"]
        for r in df.filter("count = 2").groupBy("group").agg(
            F.sum(F.col("perc") * F.col("caton")).alias("n"), F.sum("caton").alias("d")
        ).collect()
    }
    got = {r["group"]: r["p"] for r in out.filter("count = 1").groupBy("group").agg(F.max("percraise").alias("p")).collect()}
    assert got == {g: pytest.approx(want[g]) if g in want else None for g in got}
    assert out.count() == 60_000


def test_hot_lists_are_not_gathered(spark):
    members = composition.raise_lists(skewed(spark, 6000))
    hot = members.filter("group = 'hot'").orderBy("ord").collect()
    assert [r["percraise_weights"] for r in hot] == [str(i % 10 + 1) if i % 2 else "NA" for i in range(0, 6000, 3)]
    assert "collect_list" not in final_plan(members)


def test_stored_means_avoid_the_shuffle_of_rows(spark):
    df = skewed(spark).select(F.col("group").alias("index"), F.col("caton").alias("obs"))
    plan = final_plan(indices.relative_to_mean(df, "obs", "x", store_means=True))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    small = stored(df.groupBy("index").agg(F.avg("obs").alias("m")))
    assert small.count() == df.select("index").distinct().count()


def test_running_percent_of_one_hot_panel(spark):
    """All strata in one panel: the running percent is made in many window groups."""
    df = spark.range(3000).select(
        F.concat(F.lit("F"), F.col("id").cast("string")).alias("fleet"),
        F.lit("27.4").alias("area"),
        F.lit("L").alias("category"),
        (F.col("id") % 500 + 1).cast("double").alias("catch_wt"),
    )
    out = overview.stratum_summary(df, ["fleet", "area"], "LandPercent").collect()
    total, run = sum(i % 500 + 1 for i in range(3000)), 0.0
    for row in out:
        run += row["land_wt"]
        assert row["cumulative"] == pytest.approx(100 * run / total)
    assert [r["land_wt"] for r in out] == sorted((r["land_wt"] for r in out), reverse=True)
