"""Secret scan: strict patterns, and random strings told from identifiers by Markov models.

Three strict patterns (assign, access, hex) are found leftmost and without
overlap, each kind for itself; a match that fails its length check is dropped
and not retried. Beside them every run of 16 or more characters of the base64
and identifier alphabets is a candidate. Two character Markov models of order
one judge it, one of random strings and one of ordinary words, identifiers,
paths and numbers: a run counts as a secret (kind ``random``) when the sum of
its log-likelihood ratios reaches the threshold, or, where the rest
of the run speaks against it by a tenth or more (a random string within a path,
say), its best-scoring stretch of 16 or more characters. Runs of fewer than six
different characters are no random strings. Runs that overlap a strict span add nothing.

The models are trained from labelled samples. Ordinary: the distinct words of
at most ``SAMPLE_TEXTS`` texts, identifiers composed of neighbouring words,
numbers and lines of one sign; runs that mix letters and digits are unclear and left out. Random: the
digests of ``SAMPLE_RANDOM`` numbers, written in hexadecimal, base64 and other
alphabets. Every fifth sample is kept aside: the threshold is the lowest that
at most one in ``1 / FALSE`` of the ordinary ones kept aside reaches, plus
``MARGIN``.

Native column expressions throughout. Matches have no positions in SQL; they
follow from the lengths of matches and of the pieces between them. Sums along
an array are taken in blocks of the square root of its length, so a long text
with very many matches doesn't cost the square of their number. Scores are
thousandths in whole numbers, so that they don't depend on the order of sums.

Edge cases: a null text is empty and has no spans; repeated rows are judged
alike; whole texts of any length are scanned; without texts only the numbers
and random strings train the models; an empty table gives an empty result;
columns named ``base`` or ``spans`` are replaced, all others kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlens.llm.common import fresh, text_or_empty, without

# The strict patterns, in the order in which kinds are listed, and the lengths that matches need.
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = (*PATTERNS, "random")
#: what is searched: for a run of one class, asking for the length beforehand finds the same spans as checking it afterwards
_SEARCHED = PATTERNS | {"access": r"AKIA[A-Z0-9]{12,}", "hex": r"(?<![0-9a-f])[0-9a-f]{32,}"}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
START = len(ALPHABET)
MIN_RUN = 16
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
WORD = r"[A-Za-z0-9+/_-]+"

SAMPLE_TEXTS = 2000
SAMPLE_RANDOM = 20_000
#: lines of one of these characters are ordinary, up to this length
LINE_CHARACTERS, LINE = "+/_-=", 200
#: a run of fewer different characters is no random string
DIFFERENT = 6
FALSE = 1e-4
#: a factor of a thousand more, in thousandths of a nat
MARGIN = round(1000 * math.log(1000))


@dataclass
class Model:
    """Log-likelihood ratios (random against ordinary) of each pair of characters, in thousandths, and the threshold."""

    ratio: list[int]
    threshold: int


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(values: Column, step: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running results of ``step`` along an array of longs, in blocks of the square root of its length."""
    start = F.lit(zero).cast("long")
    empty = F.array().cast("array<bigint>")

    def along(xs: Column, first: Column) -> Column:
        return F.aggregate(xs, F.array(first), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x))))

    def in_blocks(vs: Column) -> Column:
        block = F.ceil(F.sqrt(F.size(vs))).cast("int")

        def cut(size: Column) -> Column:
            starts = F.sequence(F.lit(1), F.size(vs), size)
            return F.transform(starts, lambda at: along(F.slice(vs, at, size), start))

        def onward(s: Column, own: Column) -> Column:
            moved = F.transform(F.slice(own, 2, F.size(own)), lambda x: step(s["last"], x))
            return _let(moved, lambda m: F.struct(F.element_at(m, -1).alias("last"), F.concat(s["out"], m).alias("out")))

        return F.aggregate(_let(block, cut), F.struct(start.alias("last"), empty.alias("out")), onward)["out"]

    return _let(values, lambda vs: F.when(F.size(vs) > 0, in_blocks(vs)).otherwise(empty))


def _spans(text: Column, pattern: str, rank: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """Matches as structs of start, rank, end and the matched text."""
    def placed(found: Column) -> Column:
        pieces = F.zip_with(found, F.slice(F.split(text, pattern, -1), 1, F.size(found)),
                            lambda m, gap: (F.length(m) + F.length(gap)).cast("long"))
        return F.zip_with(found, _running(pieces, lambda a, b: a + b, 0), lambda m, e: F.struct(
            (e - F.length(m)).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), m.alias("match")))

    spans = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    if keep is not None:
        spans = F.filter(spans, lambda s: keep(s["match"]))
    # A first look spares the other passes over texts without any match.
    nothing = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,match:string>>")
    return F.when(text.rlike(pattern), spans).otherwise(nothing)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end")))


def strict_spans(text: Column) -> Column:
    """Strict spans of all kinds, by start, then kind as listed."""
    def long_enough(match: Column) -> Column:
        return F.length(F.regexp_extract(match, PATTERNS["assign"], 2)) >= LEAST["assign"]

    found = [_plain(_spans(text, p, rank, long_enough if kind == "assign" else None))
             for rank, (kind, p) in enumerate(_SEARCHED.items())]
    return F.array_sort(F.concat(*found))


def _scores(run: Column, ratio: Column) -> Column:
    """Struct: the ratio ``whole`` of a run, and the ratio and place of its best stretch (``best``, ``first``, ``last``)."""
    def long(x: int) -> Column:
        return F.lit(x).cast("long")

    def step(s: Column, ch: Column) -> Column:
        code = F.position(ch, F.lit(ALPHABET)).cast("long") - 1
        r = F.element_at(ratio, (s["prev"] * START + code + 1).cast("int")).cast("long")
        fresh_start = s["here"] <= 0
        here = F.when(fresh_start, r).otherwise(s["here"] + r)
        since = F.when(fresh_start, s["at"]).otherwise(s["since"])
        better = here > s["best"]
        return F.struct(code.alias("prev"), (s["at"] + 1).alias("at"), (s["whole"] + r).alias("whole"), here.alias("here"),
                        since.alias("since"), F.when(better, here).otherwise(s["best"]).alias("best"),
                        F.when(better, since).otherwise(s["first"]).alias("first"),
                        F.when(better, s["at"] + 1).otherwise(s["last"]).alias("last"))

    zero = F.struct(*[long(START if n == "prev" else 0).alias(n)
                      for n in ("prev", "at", "whole", "here", "since", "best", "first", "last")])
    return F.aggregate(F.split(run, ""), zero, step)


def _table(model_ratio: list[int]) -> Column:
    """The ratios as one folded literal."""
    return F.split(F.lit(",".join(map(str, model_ratio))), ",").cast("array<int>")


def _random_spans(runs: Column, model: Model) -> Column:
    """Accepted candidates: a whole run, or its best stretch where the rest of the run speaks against a secret."""
    table, bar = _table(model.ratio), F.lit(model.threshold)

    def judged(s: Column) -> Column:
        def place(x: Column) -> Column:
            whole = F.lit(10) * x["whole"] >= F.lit(9) * x["best"]
            return F.struct(F.when(whole, s["start"]).otherwise(s["start"] + x["first"]).alias("start"),
                            F.lit(len(PATTERNS)).alias("rank"),
                            F.when(whole, s["end"]).otherwise(s["start"] + x["last"]).alias("end"),
                            F.when(whole, x["whole"]).otherwise(x["best"]).alias("score"))

        return _let(_scores(s["match"], table), place)

    varied = F.filter(runs, lambda s: F.size(F.array_distinct(F.split(s["match"], ""))) >= DIFFERENT)
    taken = F.filter(F.transform(varied, judged), lambda c: (c["score"] >= bar) & (c["end"] - c["start"] >= MIN_RUN))
    return _plain(taken)


def _clear_of_strict(spans: Column) -> Column:
    """Of spans by start, the strict ones and those that overlap no strict one."""
    return _let(spans, _unmet)


def _unmet(merged: Column) -> Column:
    strict = len(PATTERNS)
    far = 1 << 60
    ends = _running(F.transform(merged, lambda s: F.when(s["rank"] < strict, s["end"]).otherwise(F.lit(0)).cast("long")),
                    F.greatest, 0)
    starts = F.transform(merged, lambda s: F.when(s["rank"] < strict, s["start"]).otherwise(F.lit(far)).cast("long"))
    following = F.reverse(_running(F.reverse(starts), F.least, far))
    marked = F.zip_with(F.zip_with(merged, ends, lambda s, e: F.struct(s.alias("s"), e.alias("reach"))), following,
                        lambda x, n: F.struct(x["s"].alias("s"), x["reach"].alias("reach"), n.alias("next")))
    kept = F.filter(marked, lambda x: (x["s"]["rank"] < strict) | ((x["reach"] <= x["s"]["start"]) & (x["next"] >= x["s"]["end"])))
    return F.transform(kept, lambda x: x["s"])


def _named(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.transform(spans, lambda s: F.struct(F.element_at(kinds, s["rank"] + 1).alias("kind"),
                                                 s["start"].alias("start"), s["end"].alias("end")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _ordinary(texts: DataFrame) -> DataFrame:
    """Distinct ordinary strings of the sampled texts: words, identifiers of neighbouring words, and numbers."""
    spark = texts.sparkSession
    words = F.filter(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)), lambda w: ~(
        (F.length(w) >= MIN_RUN) & w.rlike("[0-9]") & w.rlike("[A-Za-z]")))

    def composed(ws: Column) -> Column:
        def join(w: Column, i: Column) -> Column:
            b, c = (F.coalesce(F.get(ws, i + k), F.lit("value")) for k in (1, 2))
            return (F.when(i % 5 == 0, F.concat_ws("_", w, b, c)).when(i % 5 == 1, F.concat(w, F.initcap(b), F.initcap(c)))
                    .when(i % 5 == 2, F.concat_ws("-", w, b, c)).when(i % 5 == 3, F.concat_ws("/", w, b, c))
                    .otherwise(F.concat_ws("_", F.upper(w), F.upper(b), F.upper(c))))
        return F.transform(ws, join)

    both = texts.select(words.alias("w")).select(F.explode(F.concat("w", composed(F.col("w")))).alias("s"))
    n = F.col("id")
    day = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (n % 20000).cast("int")), "yyyyMMdd")
    numbers = spark.range(SAMPLE_RANDOM).select(
        F.when(n % 4 == 0, n.cast("string")).when(n % 4 == 1, day)
        .when(n % 4 == 2, F.concat(day, F.lpad((n * 7919 % 240000).cast("string"), 6, "0")))
        .otherwise(F.substring(F.translate(F.sha2(n.cast("string"), 256), "abcdef", ""), 1, 24)).alias("s"))
    lines = spark.range(1, LINE + 1).select(F.explode(F.array(
        *[F.repeat(F.lit(c), n.cast("int")) for c in LINE_CHARACTERS])).alias("s"))
    return both.unionByName(numbers).unionByName(lines).where(F.col("s") != "").distinct()


def _random(spark: SparkSession) -> DataFrame:
    """Random strings in the alphabets of keys and tokens, from digests of numbers."""
    n = F.col("id")
    text = F.regexp_replace(F.base64(F.unhex(F.sha2(n.cast("string"), 512))), r"[\r\n]", "")
    alnum = F.translate(text, "+/=", "")
    cut = (F.lit(MIN_RUN) + n % 33).cast("int")
    return spark.range(SAMPLE_RANDOM).select(
        F.when(n % 6 == 0, F.substring(F.sha2(n.cast("string"), 256), F.lit(1), cut))
        .when(n % 6 == 1, F.substring(F.upper(alnum), F.lit(1), cut))
        .when(n % 6 == 2, F.substring(F.lower(alnum), F.lit(1), cut))
        .when(n % 6 == 3, F.substring(F.translate(text, "+/", "-_"), F.lit(1), cut))
        .when(n % 6 == 4, F.substring(text, F.lit(1), cut))
        .otherwise(F.substring(alnum, F.lit(1), cut)).alias("s"))


def train(docs: DataFrame, text: str = "text", sample_texts: int = SAMPLE_TEXTS) -> Model:
    """Both models and the threshold; at most two rows for each pair of characters reach the driver."""
    spark = docs.sparkSession
    read = docs.select(F.col(text).alias("text")).where(F.col("text").isNotNull()).withColumn("key", F.xxhash64("text"))
    keys = read.select("key").distinct().orderBy("key").limit(sample_texts)  # at most ``sample_texts`` longs
    texts = read.join(F.broadcast(keys), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    samples = (_ordinary(texts).withColumn("random", F.lit(0)).unionByName(_random(spark).withColumn("random", F.lit(1)))
               .withColumn("aside", F.pmod(F.xxhash64("s"), F.lit(5)) == 0))
    coded = F.transform(F.split("s", ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    pairs = (samples.where("NOT aside").select("random", coded.alias("c"))
             .select("random", F.explode(F.zip_with(F.concat(F.array(F.lit(START)), F.slice("c", 1, F.size("c") - 1)), F.col("c"),
                                                    lambda a, b: a * START + b)).alias("pair")))
    count = [[0] * (START + 1) * START, [0] * (START + 1) * START]
    for r in pairs.groupBy("random", "pair").count().collect():
        count[r["random"]][r["pair"]] = r["count"]
    ratio = []
    for prev in range(START + 1):
        row = slice(prev * START, (prev + 1) * START)
        total = [sum(c[row]) + START / 2 for c in count]
        ratio += [round(1000 * (math.log((count[1][p] + 0.5) / total[1]) - math.log((count[0][p] + 0.5) / total[0])))
                  for p in range(row.start, row.stop)]
    scored = (samples.where((F.col("random") == 0) & F.col("aside") & (F.length("s") >= MIN_RUN))
              .select(_scores(F.col("s"), _table(ratio)).alias("x"))
              .select(F.floor(F.greatest("x.whole", "x.best") / 100).alias("score")))
    by_score = sorted(((r["score"], r["count"]) for r in scored.groupBy("score").count().collect()), reverse=True)
    above, bar = FALSE * sum(n for _, n in by_score), 0
    for score, n in by_score:
        above -= n
        if above < 0:
            bar = max(0, 100 * (score + 1))
            break
    return Model(ratio, bar + MARGIN)


def find_secrets(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Columns of ``docs`` with ``base`` and ``spans``, arrays of (kind, start, end) by start, then kind as listed."""
    kept = without(docs.columns, ("base", "spans"))
    base, runs, body = (fresh(n, docs.columns) for n in ("_base", "_runs", "_body"))
    found = docs.withColumn(body, text_or_empty(text))
    found = found.select(*docs.columns, strict_spans(F.col(body)).alias(base), _spans(F.col(body), RUN, len(PATTERNS)).alias(runs))
    found = found.select(*kept, base, F.array_sort(F.concat(base, _random_spans(F.col(runs), model))).alias(runs))
    return found.select(*kept, _named(F.col(base)).alias("base"), _named(_clear_of_strict(F.col(runs))).alias("spans"))
