"""Tables made from the fitted states of the external model.

States are rows ``(*keys, run, quantity, time, est, sd, in_est, dt)`` on the log
scale; ``run`` 0 is the full fit and run ``i`` the fit with ``i`` years removed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchframe.functions import half_even, null_safe_join, poison_avg, poison_sum, ratio, sig_round, z_value

STOCK = ("stock",)


def mohns_rho(
    states: DataFrame,
    *,
    keys: Sequence[str] = STOCK,
    quantities: Sequence[str] | None = None,
    digits: int | None = 3,
) -> DataFrame:
    """Mean relative bias of each peel's terminal value against the full run at the same time.

    ``est`` is on the natural scale here.
    """
    if quantities is not None:
        states = states.filter(F.col("quantity").isin(list(quantities)))
    terminal = (
        states.filter(F.col("run") > 0)
        .groupBy(*keys, "quantity", "run")
        .agg(F.max("time").alias("time"), F.max_by("est", "time").alias("__peel"))
    )
    on = [*keys, "quantity", "time"]
    full = states.filter(F.col("run") == 0).select(*on, "est")
    bias = null_safe_join(terminal, full, on, "left").withColumn(
        "__bias", ratio(F.col("__peel") - F.col("est"), "est")
    )
    rho = poison_avg("__bias")
    return bias.groupBy(*keys, "quantity").agg((rho if digits is None else half_even(rho, digits)).alias("rho"))


def converged_runs(states: DataFrame, runs: DataFrame, *, keys: Sequence[str] = STOCK) -> DataFrame:
    """States of the converged runs with the run's label: ``All``, ``-1``, ``-2``..."""
    on = [*keys, "run"]
    good = runs.filter(F.col("convergence") == 0).select(*on).distinct()
    label = F.when(F.col("run") == 0, F.lit("All")).otherwise(F.concat(F.lit("-"), F.col("run").cast("string")))
    return null_safe_join(states, good, on, "left_semi").withColumn("label", label)


def excluded_runs(runs: DataFrame, *, keys: Sequence[str] = STOCK) -> DataFrame:
    """Number and list of the runs that did not converge; keys without any are absent.

    ``runs`` has one row per run, so a list is as long as the number of peels.
    """
    bad = runs.filter(~F.coalesce(F.col("convergence") == 0, F.lit(False))).select(*keys, "run").distinct()
    numbers = F.transform(F.array_sort(F.collect_list("run")), lambda r: r.cast("string"))
    return bad.groupBy(*keys).agg(F.count("*").alias("n_excluded"), F.array_join(numbers, ", ").alias("excluded"))


def state_interval(
    states: DataFrame, *, quantities: Sequence[str] | None = None, level: float = 0.95
) -> DataFrame:
    """Estimate and interval on the natural scale, estimation period only."""
    z = z_value(0.5 + level / 2)
    rows = states.filter(F.col("in_est"))
    if quantities is not None:
        rows = rows.filter(F.col("quantity").isin(list(quantities)))
    return rows.withColumns({
        "lower": F.exp(F.col("est") - z * F.col("sd")),
        "estimate": F.exp("est"),
        "upper": F.exp(F.col("est") + z * F.col("sd")),
    })


def yearly_status(states: DataFrame, *, keys: Sequence[str] = STOCK, level: float = 0.95) -> DataFrame:
    """Relative pressure and biomass with their intervals at the start of each year; a year without its start has missing cells."""
    names = {"logFFmsy": "F/Fmsy", "logBBmsy": "B/Bmsy"}
    bands = state_interval(states, quantities=list(names), level=level)
    start = F.col("time") == F.floor("time")
    cells = [
        F.max(F.when(start & (F.col("quantity") == quantity), F.col(column))).alias(f"{name}{end}")
        for quantity, name in names.items() for column, end in (("estimate", ""), ("lower", "_lower"), ("upper", "_upper"))
    ]
    return bands.groupBy(*keys, F.floor("time").cast("int").alias("Year")).agg(*cells)


# How a year's sub-steps become one value.
YEARLY = {
    "last": lambda v, t: F.max_by(v, t),
    "first": lambda v, t: F.min_by(v, t),
    "mean": lambda v, t: F.avg(v),
    "sum": lambda v, t: F.sum(v),
}


def fractile_series(
    states: DataFrame,
    what: Sequence[str] = ("logBBmsy", "logFFmsy"),
    fractiles: Sequence[float] = (0.35, 0.65),
    when: str = "last",
    *,
    keys: Sequence[str] = STOCK,
    complete_only: bool = False,
    steps: int | None = None,
) -> DataFrame:
    """Yearly lognormal fractiles, one column per (quantity, fractile).

    Each year takes ``when`` (last, first, mean, sum) of its sub-steps.  With
    ``complete_only`` a year needs ``steps`` sub-steps.
    """
    if len(what) != len(fractiles):
        raise ValueError("what and fractiles must have the same length")
    if when not in YEARLY:
        raise ValueError(f"when needs to be one of {', '.join(YEARLY)}")
    if complete_only and not steps:
        raise ValueError("complete_only needs the number of sub-steps of a full year")
    pick = YEARLY[when]
    columns = []
    for quantity, fractile in zip(what, fractiles):
        hit = F.col("quantity") == quantity
        time = F.when(hit, F.col("time"))
        mean, sd = pick(F.when(hit, F.col("est")), time), pick(F.when(hit, F.col("sd")), time)
        columns.append(F.exp(mean + z_value(fractile) * sd).alias(f"{quantity.removeprefix('log')}_{fractile}"))
    rows = states.filter(F.col("quantity").isin(list(dict.fromkeys(what))))
    by_year = rows.groupBy(*keys, F.floor("time").cast("int").alias("year"))
    if not complete_only:
        return by_year.agg(*columns)
    counted = by_year.agg(*columns, F.count_distinct("time").alias("__steps"))
    return counted.filter(F.col("__steps") >= steps).drop("__steps")


def fractiles_by_table(
    states: DataFrame, wanted: DataFrame, when: str = "last", *, keys: Sequence[str] = STOCK, on: Sequence[str] = ("quantity",)
) -> DataFrame:
    """Yearly lognormal fractiles as rows ``(*keys, quantity, year, fractile, value)``, the fractiles from a table.

    ``wanted`` has ``fractile`` and the columns ``on``, ``quantity`` and any of the keys.  A fractile of 0 or 1 gives 0 or
    infinity, one outside of 0 to 1 a missing value.
    """
    if when not in YEARLY:
        raise ValueError(f"when needs to be one of {', '.join(YEARLY)}")
    pick = YEARLY[when]
    yearly = states.groupBy(*keys, "quantity", F.floor("time").cast("int").alias("year")).agg(
        pick(F.col("est"), F.col("time")).alias("__mean"), pick(F.col("sd"), F.col("time")).alias("__sd")
    )
    rows = null_safe_join(yearly, wanted.select(*on, "fractile"), list(on), "inner")
    value = F.exp(F.col("__mean") + z_value(F.col("fractile")) * F.col("__sd"))
    return rows.select(*keys, "quantity", "year", "fractile", value.alias("value"))


def status_at(
    states: DataFrame,
    when: float,
    *,
    keys: Sequence[str] = STOCK,
    biomass: str = "logBBmsy",
    pressure: str = "logFFmsy",
    fractile: float = 0.35,
) -> DataFrame:
    """Cautious biomass and fishing pressure at one time point."""
    rows = states.filter((F.col("time") == when) & F.col("quantity").isin(biomass, pressure))

    def at(quantity: str, f: float) -> Column:
        hit = F.col("quantity") == quantity
        return F.max(F.when(hit, F.exp(F.col("est") + z_value(f) * F.col("sd"))))

    return rows.groupBy(*keys).agg(
        at(biomass, fractile).alias("bbmsy_last"), at(pressure, 1 - fractile).alias("ffmsy_last")
    )


def scenario_inputs(
    states: DataFrame,
    interval: DataFrame,
    *,
    keys: Sequence[str] = STOCK,
    scenario: str = "scenario",
) -> DataFrame:
    """Per scenario: predicted landings and F/Fmsy at interval start, B/Bmsy at evaluation time.

    ``interval`` has ``(*keys, interval_start, interval_end)``.
    """
    rows = null_safe_join(states, interval.select(*keys, "interval_start", "interval_end"), keys, "inner")

    def at(quantity: str, time: str) -> Column:
        hit = (F.col("quantity") == quantity) & (F.col("time") == F.col(time))
        return F.max(F.when(hit, F.exp("est")))

    return rows.groupBy(*keys, scenario).agg(
        at("logCpred", "interval_start").alias("landings_pred"),
        at("logFFmsy", "interval_start").alias("ffmsy"),
        at("logBBmsy", "interval_end").alias("bbmsy"),
        F.max("interval_start").alias("interval_start"),
        F.max("interval_end").alias("interval_end"),
    )


def advice_line(scenarios: DataFrame, constants: DataFrame, *, keys: Sequence[str] = STOCK) -> DataFrame:
    """One advice row per scenario.

    ``constants`` has one row per key: mean discard percent, reference biomass,
    last quota, last advice.  The biomass change is relative to the new value.
    """
    rows = null_safe_join(scenarios, constants, keys, "left")
    catch = ratio(F.col("landings_pred"), 100 - F.col("mean_discard_pct")) * 100
    f = F.when(F.col("ffmsy") < 0.000001, F.lit(0.0)).otherwise(F.col("ffmsy"))
    rows = rows.withColumns({"__catch": catch, "__f": f})
    b = F.col("bbmsy")

    def change(new: Column, old: str) -> Column:
        return sig_round(ratio(new - F.col(old), old) * 100)

    return rows.select(
        *keys,
        "scenario",
        half_even("__catch").alias("total_catch"),
        half_even("landings_pred").alias("projected_landings"),
        half_even(F.col("__catch") * F.col("mean_discard_pct") / 100).alias("projected_discards"),
        sig_round("__f").alias("f_fmsy"),
        sig_round("bbmsy").alias("b_bmsy"),
        sig_round(ratio(b - F.col("biomass_ref"), "bbmsy") * 100).alias("biomass_change"),
        change(F.col("__catch"), "last_tac").alias("tac_change"),
        change(F.col("__catch"), "last_advice").alias("advice_change"),
    )


def annual_stock(
    states: DataFrame,
    discards: DataFrame | None = None,
    *,
    keys: Sequence[str] = STOCK,
    biomass: str = "logB",
    pressure: str = "logF",
) -> DataFrame:
    """Yearly stock table: biomass at the year start, mean F, catch as the sum of B*F*dt.

    ``discards`` has ``(*keys, year, discards)``; without it they are 0.
    Weights per fish are 1, so numbers equal weights.
    """

    def cell(quantity: str) -> Column:
        return F.max(F.when(F.col("quantity") == quantity, F.exp("est")))

    step = (
        states.filter(F.col("quantity").isin(biomass, pressure))
        .groupBy(*keys, "time")
        .agg(cell(biomass).alias("__b"), cell(pressure).alias("__f"), F.max("dt").alias("__dt"))
    )
    year = F.floor("time").cast("int")
    table = step.groupBy(*keys, year.alias("year")).agg(
        F.max(F.when(F.col("time") == F.floor("time"), F.col("__b"))).alias("biomass"),
        poison_avg("__f").alias("harvest"),
        poison_sum(F.col("__b") * F.col("__f") * F.col("__dt")).alias("catch"),
    )
    if discards is None:
        table = table.withColumn("discards", F.lit(0.0))
    else:
        table = null_safe_join(table, discards.select(*keys, "year", "discards"), [*keys, "year"], "left")
    return table.select(
        *keys,
        "year",
        "biomass",
        F.col("biomass").alias("stock_n"),
        "harvest",
        "catch",
        "discards",
        (F.col("catch") - F.col("discards")).alias("landings"),
    )


def production_params(params: DataFrame, *, keys: Sequence[str] = STOCK) -> DataFrame:
    """Growth rate, capacity and shape of the production curve, with the reference points."""
    n = F.col("n")
    r = ratio(F.col("m") * F.pow(n, ratio(n, n - 1)), "K")
    return params.select(
        *keys, r.alias("r"), F.col("K").alias("k"), (n - 1).alias("p"),
        F.col("Fmsy").alias("fmsy"), F.col("Bmsy").alias("bmsy"), F.col("MSY").alias("msy"),
    )


def rounded_columns(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Apply advice rounding to columns, in place or under new names."""
    names = columns if isinstance(columns, Mapping) else {c: c for c in columns}
    return df.withColumns({new: sig_round(F.col(old)) for old, new in names.items()})
