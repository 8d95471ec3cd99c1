"""Schemas of the typed tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, INT, DOUBLE, FLAG = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

CLEAN_LANDINGS = _struct(species=TEXT, area=TEXT, units=TEXT, country=TEXT, year=INT, landings=DOUBLE)
CATCH_SERIES = _struct(year=INT, landings=DOUBLE, discards=DOUBLE, total=DOUBLE)
PRELIMINARY = _struct(year=INT, species_latin=TEXT, area=TEXT, country=TEXT, ams=DOUBLE, bms=DOUBLE)
DETAILED_CATCHES = _struct(
    year=INT, area=TEXT, season=TEXT, country=TEXT, fleet=TEXT, category=TEXT, origin=TEXT, caton=DOUBLE
)
INDEX = _struct(time=DOUBLE, obs=DOUBLE, cv=DOUBLE)
RETRO_INDEX = _struct(peel=INT, semester=INT, time=DOUBLE, obs=DOUBLE, cv=DOUBLE)
STATES = _struct(
    stock=TEXT, run=INT, quantity=TEXT, time=DOUBLE, ll=DOUBLE, est=DOUBLE, ul=DOUBLE, sd=DOUBLE,
    in_est=FLAG, dt=DOUBLE,
)
RUNS = _struct(stock=TEXT, run=INT, convergence=INT)
PARAMS = _struct(stock=TEXT, m=DOUBLE, n=DOUBLE, K=DOUBLE, Fmsy=DOUBLE, Bmsy=DOUBLE, MSY=DOUBLE)
ADVICE_CONSTANTS = _struct(
    stock=TEXT, mean_discard_pct=DOUBLE, biomass_ref=DOUBLE, last_tac=DOUBLE, last_advice=DOUBLE
)
