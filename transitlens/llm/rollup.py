"""Delta-maintained token rollups.

A rollup is a folder of signed deltas: one partition per batch, holding the
batch's net documents and tokens by source, language and tokenizer version.
Totals are the sum of all deltas, so batches may arrive in any order. A batch
is written under its own id by replacing that partition as a whole: repeating
a batch, after a failure or by mistake, leaves the totals as they were.
``compact`` folds settled batches into a base with the list of their ids; such
ids are refused from then on, which keeps repeats harmless.

A revision is a delete of the old count and an insert of the new one; groups
whose net change is zero are not kept. A rollup has one writer at a time.

Edge cases: null sources, languages and versions are groups of their own; a
null count is no tokens but still a document; a null sign counts as an insert;
an empty batch is recorded as seen and changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.config import file_system
from transitlens.llm.common import BLANKS, fresh, text_or_empty

KEYS = ("source", "lang", "tokenizer")
DELTA = "source string, lang string, tokenizer string, docs long, tokens long"

# Tokenizer versions as column expressions: runs of non-blank characters; then runs of
# letters or digits and single other non-blank characters.
TOKENIZERS = {
    "words-1": lambda text: F.regexp_count(text, F.lit(f"[^{BLANKS}]+")),
    "words-2": lambda text: F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}" + BLANKS + "]")),
}


def signed(docs: DataFrame, tokenizer: str, tokens: Column, sign: Column | int = 1) -> DataFrame:
    """Signed count rows of counted documents: ``source, lang, tokenizer, tokens, sign``."""
    sign = F.lit(sign) if isinstance(sign, int) else sign
    return docs.select(F.col("source"), F.col("lang"), F.lit(tokenizer).alias("tokenizer"),
                       tokens.cast("bigint").alias("tokens"), sign.cast("int").alias("sign"))


def counted(docs: DataFrame, tokenizer: str, sign: Column | int = 1, text: str = "text") -> DataFrame:
    """Signed count rows straight from texts."""
    return signed(docs, tokenizer, TOKENIZERS[tokenizer](text_or_empty(text)), sign)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text but with its counts by every tokenizer, ``{version}``, and those of the text
    without its repeated lines, ``{version} once`` (equal where no line repeats, and then not counted again)."""
    lines, once = (fresh(n, docs.columns) for n in ("_lines", "_once"))
    d = docs.withColumn(lines, F.split(text_or_empty(text), "\n"))
    d = d.withColumn(once, F.array_distinct(lines))
    counts = {v: f(text_or_empty(text)).cast("bigint") for v, f in TOKENIZERS.items()}
    for v, n in counts.items():
        d = d.withColumn(v, n)
    repeats = F.size(once) < F.size(lines)
    for v, f in TOKENIZERS.items():
        d = d.withColumn(f"{v} once", F.when(repeats, f(F.array_join(once, "\n")).cast("bigint")).otherwise(F.col(v)))
    return d.drop(lines, once, text)


def net(rows: DataFrame) -> DataFrame:
    """Net change by group of signed count rows; partial sums merge before the shuffle."""
    sign = F.coalesce("sign", F.lit(1)).cast("bigint")
    return (rows.groupBy(*KEYS).agg(F.sum(sign).alias("docs"),
                                    F.sum(sign * F.coalesce("tokens", F.lit(0))).cast("bigint").alias("tokens"))
            .where("docs != 0 OR tokens != 0"))


class TokenRollup:
    """A rollup stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _exists(self, path: str) -> bool:
        fs, p = file_system(self.spark, path)
        return fs.exists(p)

    def _batch(self, batch_id: int) -> str:
        return f"{self.path}/deltas/batch={int(batch_id)}"

    def base_path(self) -> str | None:
        """The newest complete base; a base is complete when its list of batches is written."""
        fs, p = file_system(self.spark, f"{self.path}/base")
        if not fs.exists(p):
            return None
        done = [str(s.getPath()) for s in fs.listStatus(p) if self._exists(f"{s.getPath()}/batches/_SUCCESS")]
        return max(done, key=lambda s: int(s.rpartition("=")[2]), default=None)

    def folded(self) -> set[int]:
        """Ids of the batches in the base (one small row each)."""
        base = self.base_path()
        return {r["batch"] for r in self.spark.read.parquet(f"{base}/batches").collect()} if base else set()

    def apply(self, batch_id: int, rows: DataFrame) -> bool:
        """Commit a batch of signed count rows; false if the base already holds it.

        Every write of a batch goes to a new folder under the batch's; the
        newest complete one counts. A repeat that fails midway therefore leaves
        the committed batch as it was, and one that succeeds takes its place
        with its success mark; the older writes are deleted after that.
        """
        if batch_id in self.folded():
            return False
        before = self._writes(batch_id)
        number = max((n for n, _ in before), default=0) + 1
        net(rows).coalesce(8).write.parquet(f"{self._batch(batch_id)}/write={number}")
        for _, path in before:
            fs, p = file_system(self.spark, path)
            fs.delete(p, True)
        return True

    def _writes(self, batch_id: int) -> list[tuple[int, str]]:
        """All writes of a batch, complete or not, as (number, folder)."""
        fs, p = file_system(self.spark, self._batch(batch_id))
        found = [str(s.getPath()) for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted((int(f.rpartition("=")[2]), f) for f in found if "/write=" in f)

    def _committed(self) -> dict[int, str]:
        """The newest complete write of each batch."""
        fs, p = file_system(self.spark, f"{self.path}/deltas")
        ids = [int(s.getPath().getName().rpartition("=")[2]) for s in fs.listStatus(p)] if fs.exists(p) else []
        done = {b: [f for _, f in self._writes(b) if self._exists(f"{f}/_SUCCESS")] for b in sorted(ids)}
        return {b: f[-1] for b, f in done.items() if f}

    def committed(self) -> list[int]:
        return list(self._committed())

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` over the base and all committed batches."""
        base, folded = self.base_path(), self.folded()
        paths = [path for b, path in self._committed().items() if b not in folded]
        paths += [f"{base}/totals"] if base else []
        deltas = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        return (deltas.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .where("docs != 0 OR tokens != 0"))

    def compact(self) -> None:
        """Fold all committed batches into a new base, then drop their folders.

        Until the list of batches is complete readers use the old base and the
        deltas, so a failure at any point loses and repeats nothing.
        """
        batches = self.committed()
        folded = self.folded()
        old = self.base_path()
        new = f"{self.path}/base/version={int(old.rpartition('=')[2]) + 1 if old else 0}"
        self.totals().coalesce(8).write.mode("overwrite").parquet(f"{new}/totals")
        ids = [(b,) for b in sorted(folded | set(batches))]
        self.spark.createDataFrame(ids, "batch long").coalesce(1).write.mode("overwrite").parquet(f"{new}/batches")
        for b in batches:
            fs, p = file_system(self.spark, self._batch(b))
            fs.delete(p, True)
