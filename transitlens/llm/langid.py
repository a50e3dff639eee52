"""Language identification with a string kernel.

Two texts are compared by the byte n-grams (blended orders 1 to 4) present in
both, counted once each and normalised by the sizes of the two sets. Labelled
texts of a bounded sample are mapped by the Nystrom method onto landmark texts
drawn from that sample, and a ridge regression separates each language from
the rest.

A score is ``presence x landmarks' presence x weights``; the last two factors do not
depend on the text and are multiplied once, so a batch is scored by one sparse
presence matrix times one dense matrix.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so
is every text if nothing is labelled; ties go to the first language by name;
repeated rows are judged alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from transitlens.llm.common import fresh, without


UNDETERMINED = "und"
ORDERS = (1, 2, 3, 4)
#: n-grams are hashed into so many columns
COLUMNS = 1 << 17
#: the bounded training sample: labelled texts of each language, and landmarks among them
SAMPLE_PER_LANGUAGE = 300
LANDMARKS_PER_LANGUAGE = 64
MAX_LANGUAGES = 500
RIDGE = 1e-3
#: landmarks, or cells of the presence matrix, that a fit holds at once
BLOCK = 16
CELLS = 1 << 21

# ASCII bytes other than letters become blanks; bytes of other characters stay.
_TO_BLANK = bytes(b if b >= 0x80 or 97 <= b <= 122 else 32 for b in range(256))
_ASCII_LETTER = re.compile("[A-Za-z]")


def presence(text: str, seen: np.ndarray) -> np.ndarray:
    """Sorted columns of the n-grams present in a text; ``seen`` is an all-false scratch array."""
    words = text.lower().encode().translate(_TO_BLANK).split()
    raw = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    code = np.zeros(len(raw), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(raw) < n:
            break
        code = code[:len(raw) - n + 1] * np.uint32(257) + raw[n - 1:] + np.uint32(1)
        if n in ORDERS:
            seen[((code ^ np.uint32(n * 0x1E3779B1)) * np.uint32(2654435761)) >> np.uint32(32 - 17)] = True
    found = np.flatnonzero(seen)
    seen[found] = False
    return found


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # COLUMNS x languages

    def scores(self, texts: list[str]) -> np.ndarray:
        """One-versus-rest outputs, a row for each text."""
        seen = np.zeros(COLUMNS, bool)
        sets = [presence(t, seen) for t in texts]
        sizes = np.array([len(s) for s in sets])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        total = np.add.reduceat(self.weights[np.concatenate(sets)], starts, axis=0)
        return total / np.sqrt(sizes)[:, None]


def fit(texts: list[str], labels: list[str], landmarks_per_language: int = LANDMARKS_PER_LANGUAGE) -> Model:
    """Nystrom kernel ridge regression on a sample; the first texts of each language serve as landmarks."""
    languages = sorted(set(labels))
    chosen: list[int] = []
    for lang in languages:
        chosen += [i for i, y in enumerate(labels) if y == lang][:landmarks_per_language]
    seen = np.zeros(COLUMNS, bool)
    sets = [presence(t, seen) for t in texts]
    kernel = np.empty((len(sets), len(chosen)))
    for at in range(0, len(chosen), BLOCK):  # the landmarks' presence in full would be columns x landmarks
        block = [sets[i] for i in chosen[at:at + BLOCK]]
        marks = np.zeros((COLUMNS, len(block)), np.float32)
        for k, s in enumerate(block):
            marks[s, k] = 1 / np.sqrt(len(s))
        kernel[:, at:at + len(block)] = [marks[s].sum(0) / np.sqrt(len(s)) for s in sets]
    among = kernel[chosen]
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    kept = values > 1e-8 * values[-1]
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    features = kernel @ whiten
    target = np.array([[float(y == lang) for lang in languages] for y in labels])
    # languages weigh alike, however many texts of each the sample has
    weight = np.array([1 / labels.count(y) for y in labels])[:, None]
    gram = features.T @ (weight * features) + RIDGE * np.eye(features.shape[1])
    ridge = np.linalg.solve(gram, features.T @ (weight * target))
    parts = (whiten @ ridge).astype(np.float32)
    weights = np.empty((COLUMNS, len(languages)), np.float32)
    rows = max(1, CELLS // len(chosen))
    for at in range(0, COLUMNS, rows):
        marks = np.zeros((min(rows, COLUMNS - at), len(chosen)), np.float32)
        for k, i in enumerate(chosen):
            s = sets[i]
            marks[s[np.searchsorted(s, at):np.searchsorted(s, at + rows)] - at, k] = 1 / np.sqrt(len(s))
        weights[at:at + rows] = marks @ parts
    return Model(languages, weights)


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, doc_id: str = "doc_id",
                    text: str = "text", lang: str = "lang") -> list[tuple[str, str]]:
    """Up to ``per_language`` (text, language) rows of each language, by hash of the id.

    Ranks read only id and language; at most ``MAX_LANGUAGES`` times
    ``per_language`` texts, without copies, reach the driver.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    rows = rows.where(F.col("lang").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = (rows.select("doc_id", "lang").withColumn("_n", F.row_number().over(order))
              .where(F.col("_n") <= per_language).select("doc_id", "lang"))
    langs = ranked.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).select("lang")
    ranked = ranked.join(F.broadcast(langs), "lang").distinct()
    found = (rows.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(ranked), ["doc_id", "lang"])
             .groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
             .select("text", "lang", F.xxhash64("doc_id").alias("_h"), "doc_id").collect())
    # sorted here: a global sort would run the join twice for its bounds and shuffle the texts again
    found.sort(key=lambda r: (r["lang"], r["_h"], r["doc_id"]))
    return list(dict.fromkeys((r["text"], r["lang"]) for r in found))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang") -> Model | None:
    """A model of the labelled rows of ``docs``; None if there are none."""
    sample = labelled_sample(docs, per_language, doc_id, text, lang)
    return fit([t for t, _ in sample], [y for _, y in sample]) if sample else None


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model and (model.languages, model.weights))

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        return judged(texts, sent.value and Model(*sent.value))

    own = without(docs.columns, ("lang_pred", "score"))
    p = fresh("_p", own)
    # Marked nondeterministic so that a filter on the result is not pushed below it, which would run it twice.
    out = docs.select(*own, predict.asNondeterministic()(F.col(text)).alias(p))
    return out.select(*own, F.col(p)["lang_pred"].alias("lang_pred"), F.col(p)["score"].alias("score"))


def judged(texts: pa.Array, model: Model | None) -> pa.StructArray:
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    at, batch, size = [], [], 0

    def flush() -> None:
        if batch:
            out = model.scores(batch)
            for i, k, s in zip(at, out.argmax(1), out.max(1), strict=True):
                langs[i], scores[i] = model.languages[k], min(1.0, max(0.0, float(s)))
            at.clear()
            batch.clear()

    for i, v in enumerate(texts):
        t = v.as_py()
        if model is None or t is None or not has_letter(t):
            continue
        at.append(i)
        batch.append(t)
        size += len(t)
        if size > 1 << 20:
            flush()
            size = 0
    flush()
    return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                      ["lang_pred", "score"])
