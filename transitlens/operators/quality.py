"""Data-quality expectations: drop rules and recorded (warn) rules.

Metrics are computed with one aggregate pass (``count_if`` per rule) or, for
a frame that is written anyway, with ``DataFrame.observe`` so no extra job
runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _pred(p) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def expect_or_drop(df: DataFrame, name: str, predicate,
                   observation: Observation | None = None) -> DataFrame:
    """Keep a row only if the predicate is TRUE (false and null drop).

    With ``observation`` the pass / fail counts are recorded as
    ``{name}_passed`` / ``{name}_failed`` when the result is computed.
    """
    ok = F.coalesce(_pred(predicate), F.lit(False))
    if observation is not None:
        df = df.observe(observation, F.count_if(ok).alias(f"{name}_passed"),
                        F.count_if(~ok).alias(f"{name}_failed"))
    return df.filter(ok)


def expect_warn(df: DataFrame, rules: dict) -> DataFrame:
    """One row per rule: name, passed, failed (null verdicts count as failed)."""
    aggs = []
    for name, p in rules.items():
        ok = F.coalesce(_pred(p), F.lit(False))
        aggs += [F.count_if(ok).alias(f"{name}__p"), F.count_if(~ok).alias(f"{name}__f")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}__p`, `{n}__f`" for n in rules)
    return wide.selectExpr(f"stack({len(rules)}, {stack}) AS (expectation, passed, failed)")


def observe_warn(df: DataFrame, rules: dict, observation: Observation, table: str) -> DataFrame:
    """Attach warn rules as observed metrics (no extra pass, rows unchanged).

    Records ``{table}_rows`` and, per rule, ``{rule}_passed`` / ``{rule}_failed``.
    """
    aggs = []
    for name, p in rules.items():
        ok = F.coalesce(_pred(p), F.lit(False))
        aggs += [F.count_if(ok).alias(f"{name}_passed"), F.count_if(~ok).alias(f"{name}_failed")]
    return df.observe(observation, F.count(F.lit(1)).alias(f"{table}_rows"), *aggs)


# The rule names and predicates of the source pipeline.
BRONZE_RULES = {"bronze_has_gps_data_parsed": "gps_data_parsed IS NOT NULL"}
FLAT_INPUT_RULES = {"valid_gps_array": "gps_data_parsed IS NOT NULL AND size(gps_data_parsed) > 0"}
FLAT_RULES = {"gps_has_timestamp": "timestamp IS NOT NULL"}
TRIPS_DROP = ("valid_trip_duration", "TRIPDURATION IS NOT NULL AND TRIPDURATION > 0")
TRIPS_RULES = {"avgvelocity_reasonable": "AVGVELOCITY IS NULL OR (AVGVELOCITY > 0.01 AND AVGVELOCITY < 100)"}
