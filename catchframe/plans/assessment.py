"""Catch series and indices to model input, and model states to assessment tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from catchframe.functions import null_safe_join
from catchframe.operators import indices, modelio, states, tables


def model_tables(
    catch: DataFrame, index: DataFrame, retro: DataFrame | None = None, *, keys: Sequence[str] = ()
) -> dict[str, DataFrame]:
    """Observation tables of the model.

    ``catch`` has ``(*keys, year, landings)``, ``index`` ``(*keys, index, time, obs,
    cv)`` with the series sem1, sem2 and hist, ``retro`` ``(*keys, peel, semester,
    time, obs, cv)``.
    """
    combined = indices.labelled_index(index, indices.SERIES_LABELS, keys=keys)
    out = {
        "catch_obs": modelio.catch_input(catch, keys=keys),
        "index_obs": modelio.index_input(index, keys=keys),
        "management_interval": modelio.management_interval(catch, keys=keys),
        "index_band": indices.deviation_band(combined, keys=keys),
    }
    if retro is not None:
        hist = index.filter(index["index"] == "hist")
        out["retro_catch_obs"] = modelio.retro_catch_input(catch, retro, keys=keys)
        out["retro_index_obs"] = modelio.retro_index_input(retro, hist, keys=keys)
    return out


def assessment_tables(
    fitted: DataFrame,
    runs: DataFrame,
    params: DataFrame,
    scenarios: DataFrame,
    constants: DataFrame,
    *,
    status_time: float,
    discards: DataFrame | None = None,
    keys: Sequence[str] = states.STOCK,
) -> dict[str, DataFrame]:
    """Tables from the fitted states of all runs (log scale, run 0 is the full fit).

    ``discards`` has ``(*keys, year, discards)`` for the annual stock table.
    """
    full = fitted.filter(fitted["run"] == 0)
    converged = states.converged_runs(fitted, runs, keys=keys)
    natural = states.state_interval(converged).drop("est").withColumnRenamed("estimate", "est")
    return {
        "retro_states": natural.withColumnRenamed("est", "estimate"),
        "excluded_runs": states.excluded_runs(runs, keys=keys),
        "mohns_rho": states.mohns_rho(natural, keys=keys, quantities=["logBBmsy", "logFFmsy"]),
        "fractiles": states.fractile_series(full, keys=keys),
        "status": states.status_at(full, status_time, keys=keys),
        "annual_stock": states.annual_stock(full, discards, keys=keys),
        "production_params": states.production_params(params, keys=keys),
        "advice": states.advice_line(scenarios, constants, keys=keys),
    }


def scenario_tables(
    states_of: DataFrame, catch: DataFrame, constants: DataFrame, *, keys: Sequence[str] = states.STOCK, scenario: str = "scenario"
) -> dict[str, DataFrame]:
    """States of all scenarios to their advice: the interval comes from the catches, the scenario's values from its states.

    ``states_of`` has ``(*keys, scenario, quantity, time, est)`` on the log scale, ``catch`` ``(*keys, year, landings)``,
    ``constants`` a row per key.  A scenario without a state at a time has missing values there.
    """
    interval = modelio.management_interval(catch, keys=keys)
    chosen = states.scenario_inputs(states_of, interval, keys=keys, scenario=scenario)
    return {
        "management_interval": interval,
        "scenario_inputs": chosen,
        "advice": states.advice_line(chosen, constants, keys=keys),
    }


def summary_table(fitted: DataFrame, catch: DataFrame, *, keys: Sequence[str] = states.STOCK) -> DataFrame:
    """The assessment summary: catches, pressure and biomass with their intervals at the start of each year.

    ``fitted`` has the states of the full fit, ``catch`` ``(*keys, year, landings, discards)``; a year of the states without
    catches has missing ones.
    """
    yearly = states.yearly_status(fitted, keys=keys)
    named = catch.select(*keys, *[catch[c.lower()].alias(c) for c in ("Year", "Landings", "Discards")])
    return tables.assessment_summary(null_safe_join(yearly, named, [*keys, "Year"], "left"), keys=keys)
