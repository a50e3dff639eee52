"""Bronze -> silver: normalise the captured payload and flatten it to pings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transitlens.config import LOCAL_TZ
from transitlens.functions.numeric import cast_delay, scale_coordinates
from transitlens.functions.timefn import epoch_to_local_time, local_date
from transitlens.schemas import PAYLOAD_PARSE_TYPE, PAYLOAD_TYPE, PING_FIELDS


def _field(parent: Column, dtype: T.DataType, name: str) -> Column:
    """Field ``name`` of a struct or key ``name`` of a map; null if absent."""
    if isinstance(dtype, T.StructType):
        if name in dtype.fieldNames():
            return parent.getField(name)
        return F.lit(None)
    if isinstance(dtype, T.MapType):
        return parent.getItem(name)
    return F.lit(None)


def _to_ping(elem: Column, etype: T.DataType) -> Column:
    """One payload element (wrapped ``{element: {...}}`` or bare) -> canonical struct."""
    sources = []  # (column, type) pairs searched in order
    if isinstance(etype, T.StructType):
        if "element" in etype.fieldNames():
            sources.append((elem.getField("element"), etype["element"].dataType))
        sources.append((elem, etype))
    elif isinstance(etype, T.MapType):
        if isinstance(etype.valueType, (T.MapType, T.StructType)):
            sources.append((elem.getItem("element"), etype.valueType))
        else:
            sources.append((elem, etype))
    fields = []
    for f in PING_FIELDS:
        vals = [_field(c, t, f).cast("string") for c, t in sources]
        v = vals[0] if len(vals) == 1 else F.coalesce(*vals) if vals else F.lit(None).cast("string")
        fields.append(v.alias(f))
    return F.struct(F.struct(*fields).alias("element"))


def normalize_payload(c: Column, dtype: T.DataType) -> Column:
    """Any accepted payload array -> ``PAYLOAD_TYPE``."""
    if dtype == PAYLOAD_TYPE:
        return c
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: _to_ping(e, dtype.elementType)).cast(PAYLOAD_TYPE)
    return F.lit(None).cast(PAYLOAD_TYPE)


def parse_gps_payload(df: DataFrame, col: str = "gps_data", out: str = "gps_data_parsed") -> DataFrame:
    """Normalise the payload column to one typed array.

    * column absent      -> typed empty array (flatten then yields no rows)
    * JSON text          -> parsed; bare elements and single objects accepted,
                            malformed / empty / ``null`` text -> null
    * array              -> re-typed to the canonical struct
    * struct or map      -> one object, hence an array of one element
    * anything else      -> a typed empty array
    """
    fld = next((f for f in df.schema.fields if f.name == col), None)
    empty = F.array().cast(PAYLOAD_TYPE)
    if fld is None:
        return df.withColumn(out, empty)
    dt = fld.dataType
    if isinstance(dt, T.StringType):
        parsed = F.from_json(F.col(col), PAYLOAD_PARSE_TYPE)
        return df.withColumn(out, normalize_payload(parsed, PAYLOAD_PARSE_TYPE))
    if isinstance(dt, T.ArrayType):
        return df.withColumn(out, normalize_payload(F.col(col), dt))
    if isinstance(dt, (T.StructType, T.MapType)):
        one = F.when(F.col(col).isNotNull(), F.array(F.col(col)))
        return df.withColumn(out, normalize_payload(one, T.ArrayType(dt)))
    return df.withColumn(out, empty)


def stamp_ingest_time(df: DataFrame, out: str = "ingest_time") -> DataFrame:
    return df.withColumn(out, F.current_timestamp())


def pick_timestamp_column(df: DataFrame) -> str:
    """``timestamp`` if present, else ``ingest_time``."""
    return "timestamp" if "timestamp" in df.columns else "ingest_time"


def _epoch_of(c: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(F.col(c))
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_timestamp(F.col(c))
    return F.col(c)


def flatten_pings(df: DataFrame, col: str = "gps_data_parsed", tz: str = LOCAL_TZ, carry: tuple[str, ...] = (),
                  keep_empty: bool = False) -> DataFrame:
    """One row per payload element; null or empty arrays yield no rows, or with ``keep_empty`` one without a ping.

    ``ping_seq`` is the element's position in its capture (tie-breaker for
    pings sharing one capture time). ``carry`` names columns of the capture
    that each of its pings keeps.
    """
    if col not in df.columns:
        df = parse_gps_payload(df, out=col)
    dt = df.schema[col].dataType
    payload = normalize_payload(F.col(col), dt)
    ts_col = pick_timestamp_column(df)
    raw_ts = _epoch_of(ts_col, df.schema[ts_col].dataType)
    explode = F.posexplode_outer if keep_empty else F.posexplode
    exploded = df.select(explode(payload).alias("ping_seq", "item"), raw_ts.alias("raw_timestamp"), *carry)
    e = F.col("item.element")
    return exploded.select(
        e.BUSNUMBER.alias("BUSNUMBER"),
        cast_delay(e.DELAY).alias("DELAY"),
        e.PARADA.alias("PARADA"), e.RUTA.alias("RUTA"), e.RUTERO.alias("RUTERO"),
        e.STOPID.alias("STOPID"), e.TASKID.alias("TASKID"),
        e.TELEGRAMDATE.alias("TELEGRAMDATE"), e.TRIPID.alias("TRIPID"),
        epoch_to_local_time(F.col("raw_timestamp"), tz).alias("timestamp"),
        scale_coordinates(e.GPSX).alias("GPSX"),
        scale_coordinates(e.GPSY).alias("GPSY"),
        F.col("ping_seq").cast("long").alias("ping_seq"), *carry,
    ).withColumn("date", local_date(F.col("timestamp")))
