"""Shared helpers: tables in the shared folder, text keys, word and bucket rules."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transitlens.config import file_system, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: the white space of the word rules: blank and 0x09 to 0x0D
BLANKS = " \t\n\x0b\x0c\r"
#: rows up to which a join is left to Spark's estimate of bytes
AUTO_ROWS = 100_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder, read back.

    Cuts the lineage where every executor can read it again; the folder goes
    when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def written_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``written`` with the number of rows, observed on the write: counting the stored table takes jobs of its own."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, seen.get["n"]


def by_shuffle_beyond(df: DataFrame, rows: int) -> DataFrame:
    """``df`` for a join that Spark may turn into a broadcast up to ``AUTO_ROWS`` rows only.

    Spark estimates a stored table by the bytes of its files and does not see
    that a generator multiplies rows, so what it broadcasts as small may be
    hundreds of times larger in the driver's heap.
    """
    return df if rows <= AUTO_ROWS else df.hint("merge")


def discard(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    fs, p = file_system(df.sparkSession, df.scratch)
    fs.delete(p, True)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def text_key(text: Column) -> Column:
    """128-bit content key: rows with equal texts share one unit of work."""
    return F.unhex(F.md5(F.encode(text, "UTF-8")))


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of 1,000 rows where the session keeps Spark's default of 10,000.

    Texts are long rows: ten thousand of them at once cost every Python worker
    and its executor some hundred MB for nothing.
    """
    key, default = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, "1000")


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20,
           max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Cut and join Arrow batches so that one piece holds about ``max_bytes`` of ``column``.

    Bounds the working set of a task whatever the length of single texts; a
    text longer than the bound is a piece of its own.
    """
    held: list[pa.RecordBatch] = []
    total = rows = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = 0
        for i, n in enumerate(sizes):
            if rows and (total + n > max_bytes or rows >= max_rows):
                if i > start:
                    held.append(batch.slice(start, i - start))
                yield pa.concat_batches(held)
                held, start, total, rows = [], i, 0, 0
            total += n
            rows += 1
        if len(sizes) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.concat_batches(held)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it (names compare without case, as in Spark)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def without(columns: list[str], replaced: tuple[str, ...] | list[str]) -> list[str]:
    """Columns that an operator's own results do not replace."""
    gone = {c.lower() for c in replaced}
    return [c for c in columns if c.lower() not in gone]


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; looks at no more than that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """A broadcast hint behind a row count; beyond the bound the join shuffles."""
    return F.broadcast(df) if within(df, max_rows) else df
