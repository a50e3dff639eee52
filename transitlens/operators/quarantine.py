"""Malformed captures and elements leave the main path with a reason; metrics of runs are compared.

``parse_with_quarantine`` reads each payload once. What can be used goes on in
``gps_data_parsed``; what can't is listed in ``quarantined``, a whole capture
or single elements of it, so rows in are always rows parsed plus rows set
aside. Both are columns of the same row: the quarantine table of a written
layer reads that one column.

Reasons of captures: ``no_payload`` (null or no such column), ``empty_text``,
``null_text`` (the JSON value null), ``malformed_json``, ``not_pings`` (another
JSON value than objects, or another type). The reason of an element:
``empty_element`` (null, or none of the ping's fields). A payload
without elements is parsed and gives no ping. A number that can't be read is
not malformed: the ping stays, with a null (as in ``flatten_pings``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.functions.numeric import safe_ratio
from transitlens.operators.payload import parse_gps_payload
from transitlens.schemas import PAYLOAD_TYPE, PING_FIELDS

QUARANTINED_TYPE = "array<struct<pos:int,reason:string>>"


def _capture_reason(df: DataFrame, col: str, parsed: Column) -> Column:
    """Why a capture's payload has no parsed array; null if it has one."""
    field = next((f for f in df.schema.fields if f.name == col), None)
    if field is None:
        return F.lit("no_payload")
    raw = F.col(col)
    if not isinstance(field.dataType, T.StringType):
        usable = isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType))
        return F.when(raw.isNull(), "no_payload").when(F.lit(not usable), "not_pings")
    text = F.trim(raw)
    return (F.when(raw.isNull(), "no_payload").when(text == "", "empty_text").when(text == "null", "null_text")
            .when(parsed.isNull() & F.try_parse_json(raw).isNull(), "malformed_json").when(parsed.isNull(), "not_pings"))


def _element_reason(e: Column) -> Column:
    return F.when(reduce(lambda a, b: a & b, [e["element"][f].isNull() for f in PING_FIELDS]), "empty_element")


def parse_with_quarantine(df: DataFrame, col: str = "gps_data") -> DataFrame:
    """``gps_data_parsed`` (usable elements in order, null for a quarantined capture) and ``quarantined``.

    An entry of ``quarantined`` has the element's position, or null for the
    whole capture, and the reason.
    """
    out = parse_gps_payload(df, col, "_parsed")
    reason = _capture_reason(df, col, F.col("_parsed"))
    out = out.withColumn("_reason", reason)
    judged = F.transform("_parsed", lambda e, i: F.struct(i.cast("int").alias("pos"), _element_reason(e).alias("reason"), e.alias("e")))
    out = out.withColumn("_judged", F.when(F.col("_reason").isNull(), judged))
    good = F.transform(F.filter("_judged", lambda j: j["reason"].isNull()), lambda j: j["e"]).cast(PAYLOAD_TYPE)
    bad = F.transform(F.filter("_judged", lambda j: j["reason"].isNotNull()), lambda j: F.struct(j["pos"], j["reason"]))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("pos"), F.col("_reason").alias("reason")))
    return (out.withColumn("gps_data_parsed", good)
            .withColumn("quarantined", F.when(F.col("_reason").isNotNull(), whole).otherwise(bad).cast(QUARANTINED_TYPE))
            .drop("_parsed", "_reason", "_judged"))


def quarantine_table(parsed: DataFrame, *keep: str) -> DataFrame:
    """One row for each quarantined capture or element: columns in ``keep``, ``pos`` and ``reason``."""
    return parsed.select(*keep, F.inline("quarantined"))


def quarantine_report(parsed: DataFrame) -> DataFrame:
    """``unit`` (capture, element), ``reason`` (null: parsed) and ``n``; one pass."""
    whole = F.exists("quarantined", lambda q: q["pos"].isNull())
    units = F.when(whole, F.transform("quarantined", lambda q: F.struct(F.lit("capture").alias("unit"), q["reason"].alias("reason"), F.lit(1).alias("n")))
                   ).otherwise(F.concat(
                       F.array(F.struct(F.lit("capture").alias("unit"), F.lit(None).cast("string").alias("reason"), F.lit(1).alias("n")),
                               F.struct(F.lit("element").alias("unit"), F.lit(None).cast("string").alias("reason"), F.size("gps_data_parsed").alias("n"))),
                       F.transform("quarantined", lambda q: F.struct(F.lit("element").alias("unit"), q["reason"].alias("reason"), F.lit(1).alias("n")))))
    return parsed.select(F.inline(units)).groupBy("unit", "reason").agg(F.sum("n").alias("n")).filter("n > 0")


def metric_history(spark: SparkSession, metrics: dict[int, dict[str, int]]) -> DataFrame:
    """``version, rule, passed, failed`` from the metrics of published versions."""
    rows = []
    for version, values in metrics.items():
        rules = [n[:-len("_passed")] for n in values if n.endswith("_passed")]
        rows += [(version, r, int(values[f"{r}_passed"]), int(values.get(f"{r}_failed", 0))) for r in rules]
    return spark.createDataFrame(rows, "version long, rule string, passed long, failed long")


def metric_changes(history: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Each version's share of failed rows against the mean share of the versions before it.

    ``version, rule, failed_share, usual_share, alert``; ``alert`` says that the
    share is higher than usual by more than ``tolerance``. A rule's first version
    has no usual share and no alert. One row for each version and rule: a window
    by rule is small.
    """
    share = history.withColumn("failed_share", safe_ratio(F.col("failed").cast("double"), F.col("passed") + F.col("failed")))
    before = Window.partitionBy("rule").orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    usual = F.avg("failed_share").over(before)
    return share.select("version", "rule", "failed_share", usual.alias("usual_share")).withColumn(
        "alert", F.coalesce(F.col("failed_share") > F.col("usual_share") + F.lit(tolerance), F.lit(False)))
