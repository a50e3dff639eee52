"""Hashed maximum-entropy language model with a class-factored softmax.

Words are lower-cased runs of non-blank characters, and every text ends with
one end token. The most frequent words form head classes of ``WIDTH`` words; all
others fall into tail classes by the hash of their last two bytes, which
follows languages and word endings. With the two words before it as context,

    p(word) = p(class | context) * p(word | class, context)

The first factor is a softmax over classes, the second one over the words of a
head class; both sum weights of hashed features: bias, bigram, skip (the word
before the last) and, for classes, trigram. A tail class is a tree of ``WIDTH``-way
softmaxes along the digits of a word's hash, as deep as the vocabulary needs;
each sums its bias and hashed bigram and skip features of the two real words
before. Inside a leaf words keep their smoothed share of the leaf's training
tokens, unseen words counting as one more type, so the whole is a proper
distribution.

Training sees every training text: words are counted, texts become symbols
(head words and tail classes), and counts of symbol trigrams, at most the cube
of the symbol count, are the sufficient statistics. Each round every partition
of that table sums what its contexts observe and what the model expects for
each hashed feature - the two halves of the gradient - and the weights move by a
step scaled to their ratio, which stays bounded whatever a feature's frequency.

For tail words the statistics are pairs (hashed context word, hashed word), of
neighbours and of words one apart, over all training texts; they grow with the
corpus and are shuffled by the block of weights that they touch, so each block's
sums are complete in one task. Their weights start from the tree's biases, where
the expectation of both feature kinds follows from pairs alone, and take one
iterative-scaling step (half the log ratio, as two features are active).

Scoring looks up the factors of each context in batches. Counts of words come
from a broadcast dictionary of bounded size for frequent words, and from a join
for all others.

Edge cases: a null text is empty and has the end token alone; without training
texts all words are unseen; repeated rows are scored alike.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm.common import slices, written

HEAD_CLASSES = 16
WIDTH = 16
TAIL_CLASSES = 16
CLASSES = HEAD_CLASSES + TAIL_CLASSES
HEAD = HEAD_CLASSES * WIDTH
START = HEAD + TAIL_CLASSES
SYMBOLS = START + 1
#: hashed rows of class weights and of word weights
CLASS_ROWS = 1 << 15
WORD_ROWS = 1 << 14
ROUNDS = 10
RATE = 0.4
#: observations that every weight is given on either side, against over-fitting rare features
PRIOR = 1.0
PARTITIONS = 12
#: at most so many frequent words are broadcast with their counts
HOT_WORDS = 1 << 17
SMOOTH = 0.1
END = b""
#: a tail tree is deepened until its leaves hold at most so many distinct words on average
LEAF_WORDS = 128
MAX_DEPTH = 6
#: hashed rows of tail weights, in blocks that one task sums; weights are kept in steps of 1 / STEP
BLOCK_BITS = 10
BLOCK_ROWS = 1 << 11
STEP = 32
TAIL_RATE = 0.5
TAIL_PRIOR = 2.0
#: pairs that a task counts before it sends them on
PAIRS_HELD = 1 << 20
TAIL_PARTITIONS = 64
#: tokens of tail words that are scored side by side
PORTION = 1 << 14
#: bytes of text that are read side by side
SLICE_BYTES, WORD_BYTES = 4 << 20, 8 << 20
#: context of a text's first words
NO_WORD = 1


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text (ASCII rules on bytes), then the end token."""
    out = (text or b"").lower().split()
    out.append(END)
    return out


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAIL_CLASSES


def _binary(part: pa.RecordBatch, column: str) -> list[bytes | None]:
    return part.column(column).cast(pa.binary()).to_pylist()


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, list[bytes]]:
    """Number of tokens of each text, and all of them in order."""
    flat: list[bytes] = []
    lengths = []
    for t in texts:
        words = words_of(t)
        lengths.append(len(words))
        flat += words
    return np.array(lengths, np.int64), flat


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` over all texts (column ``text``); tasks pre-count in bounded portions, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", WORD_BYTES):
            counted = pc.value_counts(pa.array(_tokens(_binary(part, "text"))[1], pa.binary()))
            yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], ["word", "c"])

    return (texts.select("text").mapInArrow(run, "word binary, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


def frequent(counts: DataFrame, most: int = HOT_WORDS) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``most``: all whose count reaches a bound found from a short histogram."""
    band = F.floor(F.log2("c") * 16).cast("int")
    sizes = sorted(((r["b"], r["n"]) for r in counts.groupBy(band.alias("b")).agg(F.count("*").alias("n")).collect()),
                   reverse=True)
    total, bound = 0, None
    for b, n in sizes:
        if total + n > most:
            break
        total, bound = total + n, b
    if bound is None and sizes:  # one band exceeds the bound: take its first words
        rows = counts.where(band == sizes[0][0]).orderBy(F.desc("c"), "word").limit(HEAD).collect()
    else:
        rows = counts.where(band >= (bound if bound is not None else 0)).collect() if sizes else []
    return sorted(((bytes(r["word"]), r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


class Lexicon:
    """Frequent words with symbols and counts."""

    def __init__(self, hot: list[tuple[bytes, int]]):
        self.words = pa.array([w for w, _ in hot], pa.binary())
        self.counts = np.array([c for _, c in hot] + [0], np.float64)
        self.symbols = np.array([i if i < HEAD else HEAD + tail_class(w) for i, (w, _) in enumerate(hot)] + [0], np.int64)
        self.hashes = np.array([zlib.crc32(w) for w, _ in hot] + [0], np.uint64)

    def read(self, texts: list[bytes | None], list_rare: bool = False
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[Counter]]:
        """Of a batch: lengths, hot index (-1: none), symbol, context and hash of every token, and each text's rare words.

        All tokens are looked up at once; only rare ones are looked at singly.
        """
        size, tokens = _tokens(texts)
        hot = pc.fill_null(pc.index_in(pa.array(tokens, pa.binary()), value_set=self.words), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(hot < 0)
        words = [tokens[i] for i in new.tolist()]
        symbol, hashes = self.symbols[hot], self.hashes[hot]
        symbol[new] = [HEAD + tail_class(w) for w in words]
        hashes[new] = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
        first = np.cumsum(size) - size
        rare: list[Counter] = []
        if list_rare:
            start = 0
            for end in np.searchsorted(new, first + size).tolist():
                rare.append(Counter(words[start:end]))
                start = end
        one = np.empty_like(symbol)
        one[1:] = symbol[:-1]
        one[first] = START
        two = np.empty_like(symbol)
        two[1:] = one[:-1]
        two[first] = START
        return size, hot, symbol, two * SYMBOLS + one, hashes, rare


def trigram_counts(texts: DataFrame, sent: Broadcast) -> DataFrame:
    """``code, n``: how often each symbol follows each context, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(sent.value)
        codes, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for part in slices(batches, "text", SLICE_BYTES):
            _, _, symbol, context, _, _ = lexicon.read(_binary(part, "text"))
            new, k = np.unique(context * SYMBOLS + symbol, return_counts=True)
            both, where = np.unique(np.concatenate([codes, new]), return_inverse=True)
            codes, n = both, np.bincount(where, np.concatenate([n, k])).astype(np.int64)
        if len(codes):
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n)], ["code", "n"])

    return texts.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def _mixed(kind: int, x: np.ndarray) -> np.ndarray:
    z = x.astype(np.uint64) + np.uint64((kind + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _hash(kind: int, x: np.ndarray, rows: int) -> np.ndarray:
    return (_mixed(kind, x) % np.uint64(rows)).astype(np.int64)


def class_features(context: np.ndarray) -> np.ndarray:
    """Rows of the class weights for contexts: bias, bigram, skip, trigram."""
    two, one = np.divmod(context, SYMBOLS)
    return np.stack([_hash(0, np.zeros_like(one), CLASS_ROWS), _hash(1, one, CLASS_ROWS),
                     _hash(2, two, CLASS_ROWS), _hash(3, context, CLASS_ROWS)], 1)


def word_features(context: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Rows of the word weights for contexts within a head class: bias, bigram, skip."""
    two, one = np.divmod(context, SYMBOLS)
    return np.stack([_hash(4, head, WORD_ROWS), _hash(5, one * HEAD_CLASSES + head, WORD_ROWS),
                     _hash(6, two * HEAD_CLASSES + head, WORD_ROWS)], 1)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _sums(features: np.ndarray, seen: np.ndarray, expected: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Touched rows and, for each, observed and expected sums side by side."""
    total = np.zeros((rows, 2 * seen.shape[1]), np.float32)
    both = np.concatenate([seen, expected], 1).astype(np.float32)
    for k in range(features.shape[1]):
        np.add.at(total, features[:, k], both)
    touched = np.unique(features)
    return touched, total[touched]


def gradients(code: np.ndarray, n: np.ndarray, class_w: np.ndarray, word_w: np.ndarray,
              mask: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(level, touched rows, observed and expected sums) of counted trigrams."""
    context, symbol = np.divmod(code, SYMBOLS)
    klass = np.where(symbol < HEAD, symbol // WIDTH, symbol - HEAD + HEAD_CLASSES)
    own, at = np.unique(context, return_inverse=True)
    seen = np.bincount(at * CLASSES + klass, n, len(own) * CLASSES).reshape(-1, CLASSES)
    rows = class_features(own)
    p = np.exp(_log_softmax(class_w[rows].sum(1)))
    total = seen.sum(1, keepdims=True)
    out = [(0, *_sums(rows, seen, total * p, CLASS_ROWS))]
    head = symbol < HEAD
    pair, at = np.unique(at[head] * HEAD_CLASSES + klass[head], return_inverse=True)
    seen = np.bincount(at * WIDTH + symbol[head] % WIDTH, n[head], len(pair) * WIDTH).reshape(-1, WIDTH)
    which = pair % HEAD_CLASSES
    rows = word_features(own[pair // HEAD_CLASSES], which)
    p = np.exp(_log_softmax(word_w[rows].sum(1) + mask[which]))
    total = seen.sum(1, keepdims=True)
    out.append((1, *_sums(rows, seen, total * p, WORD_ROWS)))
    return out


def word_mask(n_head: int) -> np.ndarray:
    """-1e9 at places of head classes that hold no word (a class without words is never looked up)."""
    mask = np.where(np.arange(HEAD).reshape(HEAD_CLASSES, WIDTH) < n_head, 0.0, -1e9)
    mask[mask.max(1) < 0] = 0.0
    return mask


def train(trigrams: DataFrame, n_head: int, rounds: int = ROUNDS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """(class weights, word weights) by synchronous updates over the partitions of the trigram table.

    A partition sends only rows that it touched: the sums of one round are
    bounded by the weight tables, whatever the corpus size.
    """
    spark = trigrams.sparkSession
    context = F.floor(F.col("code") / SYMBOLS)
    table = written(trigrams.repartition(PARTITIONS, context), "trigrams")
    mask = word_mask(n_head)
    weights = [np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((WORD_ROWS, WIDTH), np.float32)]
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast([*weights, mask])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            got = [(b.column("code").to_numpy(), b.column("n").to_numpy()) for b in batches]
            if got:
                code, n = (np.concatenate(x) for x in zip(*got))
                found = gradients(code, n, *sent.value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([level for level, _, _ in found], pa.int32()),
                     pa.array([rows.astype("<i4").tobytes() for _, rows, _ in found], pa.binary()),
                     pa.array([sums.astype("<f4").tobytes() for _, _, sums in found], pa.binary())],
                    ["level", "rows", "sums"])

        totals = [np.zeros((len(w), 2 * w.shape[1]), np.float32) for w in weights]
        for r in table.mapInArrow(run, "level int, rows binary, sums binary").toLocalIterator(prefetchPartitions=True):
            rows = np.frombuffer(r["rows"], "<i4")
            totals[r["level"]][rows] += np.frombuffer(r["sums"], "<f4").reshape(len(rows), -1)
        for w, t in zip(weights, totals, strict=True):
            seen, expected = np.split(t, 2, axis=1)
            w += rate * np.log((seen + PRIOR) / (expected + PRIOR))
        sent.unpersist()
    return weights[0], weights[1]


def tables(class_w: np.ndarray, word_w: np.ndarray, n_head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Factors of every context: log class shares, log normalisers of head classes, and word weights of either neighbour."""
    every = np.arange(SYMBOLS * SYMBOLS)
    shares = np.empty((len(every), CLASSES), np.float32)
    for at in range(0, len(every), 1 << 13):
        shares[at:at + (1 << 13)] = _log_softmax(class_w[class_features(every[at:at + (1 << 13)])].sum(1))
    one = np.arange(SYMBOLS)
    mask = word_mask(n_head)
    near, skip = (np.empty((SYMBOLS, HEAD_CLASSES, WIDTH), np.float32) for _ in range(2))
    for c in range(HEAD_CLASSES):
        rows = word_features(one * SYMBOLS + one, np.full(SYMBOLS, c))
        near[:, c] = word_w[rows[:, 0]] + word_w[rows[:, 1]] + mask[c]
        skip[:, c] = word_w[rows[:, 2]]
    norm = np.empty((len(every), HEAD_CLASSES), np.float32)
    for two in range(SYMBOLS):
        z = near + skip[two]
        top = z.max(2, keepdims=True)
        norm[two * SYMBOLS:(two + 1) * SYMBOLS] = np.log(np.exp(z - top).sum(2)) + top[:, :, 0]
    return shares, norm, near.reshape(SYMBOLS, HEAD), skip.reshape(SYMBOLS, HEAD)


def log_head(context: np.ndarray, symbol: np.ndarray, shares, norm, near, skip) -> np.ndarray:
    """log p(class | context), plus log p(word | class, context) for head words."""
    klass = np.where(symbol < HEAD, symbol // WIDTH, symbol - HEAD + HEAD_CLASSES)
    out = shares[context, klass].astype(np.float64)
    head = np.flatnonzero(symbol < HEAD)
    c, s = context[head], symbol[head]
    out[head] += near[c % SYMBOLS, s] + skip[c // SYMBOLS, s] - norm[c, s // WIDTH]
    return out


def tail_depth(types: int) -> int:
    """Levels of a tail tree, so that leaves hold ``LEAF_WORDS`` of ``types`` words or fewer on average."""
    depth = 1
    while depth < MAX_DEPTH and TAIL_CLASSES * WIDTH ** depth * LEAF_WORDS < types:
        depth += 1
    return depth


def tail_shares(mass: np.ndarray, depth: int) -> list[np.ndarray]:
    """Of every level, the share of each digit in its node, from the mass of the leaves."""
    out = []
    for k in range(depth - 1, -1, -1):
        by_digit = mass.reshape(TAIL_CLASSES, WIDTH, WIDTH ** k).transpose(0, 2, 1).reshape(-1, WIDTH)
        mass = by_digit.sum(1)
        out.append((by_digit / mass[:, None]).astype(np.float32))
    return out[::-1]


def _paths(hashes: np.ndarray, depth: int) -> np.ndarray:
    return (hashes.astype(np.uint64) >> np.uint64(8)) & np.uint64(WIDTH ** depth - 1)


def _contexts(hashes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word before each token and of the one before that."""
    first = np.cumsum(size) - size
    one = np.empty_like(hashes)
    one[1:] = hashes[:-1]
    one[first] = NO_WORD
    two = np.empty_like(hashes)
    two[1:] = one[:-1]
    two[first] = NO_WORD
    return one, two


def _groups(kind: int, context: np.ndarray, klass: np.ndarray) -> np.ndarray:
    """Feature kind, context word and tail class as one number."""
    return context.astype(np.uint64) << np.uint64(8) | np.uint64(kind << 4) | klass.astype(np.uint64)


def _tail_rows(mixed: np.ndarray, level: int, prefix: np.ndarray) -> np.ndarray:
    """Rows within the block ``mixed >> (64 - BLOCK_BITS)`` of the weights of a group at a node."""
    return _hash(level, mixed ^ (prefix << np.uint64(20)), BLOCK_ROWS)


def tail_pairs(texts: DataFrame, sent: Broadcast, depth: int) -> DataFrame:
    """``block, pairs, n``: (group of a context word, path of a tail word) and their counts, packed by block of weights."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        code, n = np.unique(np.concatenate(held), return_counts=True)
        block = (_mixed(0, code >> np.uint64(24)) >> np.uint64(64 - BLOCK_BITS)).astype(np.int16)
        order = np.argsort(block, kind="stable")
        code, n, block = code[order], n[order].astype("<u4"), block[order]
        own, at = np.unique(block, return_index=True)
        ends = np.append(at[1:], len(code))
        # byte planes of sorted numbers compress well
        return pa.RecordBatch.from_arrays(
            [pa.array(own.astype(np.int32)),
             pa.array([np.ascontiguousarray(code[a:b].astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()
                       for a, b in zip(at, ends)], pa.binary()),
             pa.array([np.ascontiguousarray(n[a:b].view(np.uint8).reshape(-1, 4).T).tobytes()
                       for a, b in zip(at, ends)], pa.binary())], ["block", "pairs", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, held, total = Lexicon(sent.value), [], 0
        for part in slices(batches, "text", 2 << 20):
            size, _, symbol, _, hashes, _ = lexicon.read(_binary(part, "text"))
            tail = np.flatnonzero(symbol >= HEAD)
            klass, path = symbol[tail] - HEAD, _paths(hashes[tail], depth)
            for kind, context in enumerate(_contexts(hashes, size)):
                held.append(_groups(kind, context[tail], klass) << np.uint64(24) | path)
                total += len(tail)
            if total > PAIRS_HELD:
                yield packed(held)
                held, total = [], 0
        if total:
            yield packed(held)

    return texts.select("text").mapInArrow(run, "block int, pairs binary, n binary")


def _unpacked(blob: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def tail_sums(code: np.ndarray, n: np.ndarray, shares: list[np.ndarray], seen: np.ndarray, expected: np.ndarray) -> None:
    """Add what counted pairs of one block observe, and what the biases expect, to the block's rows."""
    group, path = code >> np.uint64(24), code & np.uint64((1 << 24) - 1)
    mixed, klass = _mixed(0, group), group & np.uint64(TAIL_CLASSES - 1)
    for k, share in enumerate(shares):
        prefix = path & np.uint64(WIDTH ** k - 1)
        digit = ((path >> np.uint64(4 * k)) & np.uint64(WIDTH - 1)).astype(np.int64)
        row = _tail_rows(mixed, k, prefix)
        seen += np.bincount(row * WIDTH + digit, n, seen.size).reshape(seen.shape)
        order = np.argsort(row.astype(np.int16), kind="stable")
        own, at = np.unique(row[order], return_index=True)
        node = (klass << np.uint64(4 * k) | prefix).astype(np.int64)[order]
        expected[own] += np.add.reduceat(share[node] * n[order, None].astype(np.float32), at, axis=0)


def tail_weights(pairs: DataFrame, shares: list[np.ndarray]) -> np.ndarray:
    """Weights of all blocks, in steps of 1 / STEP; a block's pairs meet in one task."""
    sent = pairs.sparkSession.sparkContext.broadcast(shares)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        total = 0
        sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def add(block: int) -> None:
            if block not in sums:
                sums[block] = tuple(np.zeros((BLOCK_ROWS, WIDTH)) for _ in range(2))
            code, n = (np.concatenate(x) for x in zip(*held.pop(block)))
            tail_sums(code, n, sent.value, *sums[block])

        for b in batches:
            for block, codes, n in zip(*(b.column(c).to_pylist() for c in ("block", "pairs", "n"))):
                held.setdefault(block, []).append((_unpacked(codes, "<u8"), _unpacked(n, "<u4")))
                total += len(held[block][-1][0])
            if total > PAIRS_HELD:
                for block in list(held):
                    add(block)
                total = 0
        for block in list(held):
            add(block)
        for block, (seen, expected) in sums.items():
            w = TAIL_RATE * np.log((seen + TAIL_PRIOR) / (expected + TAIL_PRIOR))
            small = np.clip(np.rint(w * STEP), -127, 127).astype(np.int8)
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([small.tobytes()], pa.binary())],
                                             ["block", "w"])

    out = np.zeros((1 << BLOCK_BITS, BLOCK_ROWS, WIDTH), np.int8)
    for r in pairs.repartition(TAIL_PARTITIONS, "block").mapInArrow(run, "block int, w binary").collect():
        out[r["block"]] = np.frombuffer(r["w"], np.int8).reshape(BLOCK_ROWS, WIDTH)
    return out.reshape(-1, WIDTH)


def log_tail(klass: np.ndarray, path: np.ndarray, one: np.ndarray, two: np.ndarray, biases: list[np.ndarray],
             weights: np.ndarray) -> np.ndarray:
    """log p(leaf | tail class, the two words before): at each level a softmax over 16 digits."""
    # portions that stay in the processor's cache
    parts = [slice(i, i + PORTION) for i in range(0, len(klass), PORTION)]
    return np.concatenate([np.zeros(0), *[_log_tail(klass[p], path[p], one[p], two[p], biases, weights) for p in parts]])


def _log_tail(klass: np.ndarray, path: np.ndarray, one: np.ndarray, two: np.ndarray, biases: list[np.ndarray],
              weights: np.ndarray) -> np.ndarray:
    out = np.zeros(len(klass))
    mixed = [_mixed(0, _groups(kind, context, klass)) for kind, context in enumerate((one, two))]
    first = [(m >> np.uint64(64 - BLOCK_BITS)).astype(np.int64) * BLOCK_ROWS for m in mixed]
    every = np.arange(len(klass))
    for k, bias in enumerate(biases):
        prefix = path & np.uint64(WIDTH ** k - 1)
        near, skip = (f + _tail_rows(m, k, prefix) for f, m in zip(first, mixed))
        z = weights.take(near, 0).astype(np.float32)
        z += weights.take(skip, 0)
        z *= np.float32(1 / STEP)
        z += bias.take(klass << (4 * k) | prefix.astype(np.int64), 0)
        digit = ((path >> np.uint64(4 * k)) & np.uint64(WIDTH - 1)).astype(np.int64)
        out += z[every, digit]
        np.exp(z, out=z)
        out -= np.log(np.einsum("ij->i", z))
    return out


SCORED = "doc_id {}, held_out boolean, n_tokens long, known long, base double, model double, rare array<struct<word:binary,n:int>>"


def score(docs: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Train on rows where ``held_out`` (a boolean column) is false; score every row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out.alias("held_out"))
    training = rows.where(~F.col("held_out")).select("text")
    counts = written(word_counts(training), "word-counts")
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = whole["n"], whole["v"]
    hot = frequent(counts)
    n_head = min(HEAD, len(hot))
    dictionary = spark.sparkContext.broadcast(hot)
    trigrams = trigram_counts(training, dictionary)
    factors = tables(*train(trigrams, n_head, rounds), n_head)
    # Leaves of the tail trees: tokens and types of all words but the head's.
    depth = tail_depth(v)
    ending = F.pmod(F.crc32(F.when(F.length("word") > 2, F.substring("word", -2, 2)).otherwise(F.col("word"))),
                    F.lit(TAIL_CLASSES))
    path = F.shiftright(F.crc32("word"), 8).bitwiseAND(F.lit(WIDTH ** depth - 1))
    head_words = F.broadcast(spark.createDataFrame([(bytearray(w),) for w, _ in hot[:HEAD]], "word binary"))
    leaves = (counts.join(head_words, "word", "left_anti").groupBy((ending * WIDTH ** depth + path).alias("leaf"))
              .agg(F.sum("c").alias("n"), F.count("*").alias("v")).toArrow())
    mass = np.full(TAIL_CLASSES * WIDTH ** depth, SMOOTH)
    mass[leaves["leaf"].to_numpy()] += leaves["n"].to_numpy() + SMOOTH * leaves["v"].to_numpy()
    shares = tail_shares(mass, depth)
    weights = tail_weights(tail_pairs(training, dictionary, depth), shares)
    sent = spark.sparkContext.broadcast((factors, np.log10(mass).astype(np.float32), [np.log(s) for s in shares], weights))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, spread, biases, weights = sent.value
        lexicon = Lexicon(dictionary.value)
        logs = np.log10(lexicon.counts + SMOOTH)
        logs[-1] = 0.0  # words outside the dictionary are added by the join
        for part in slices(batches, "text", 2 << 20):
            size, hot, symbol, context, hashes, rare = lexicon.read(_binary(part, "text"), list_rare=True)
            first = np.cumsum(size) - size
            model = log_head(context, symbol, *parts) / np.log(10)
            tail = np.flatnonzero(symbol >= HEAD)
            klass, path = symbol[tail] - HEAD, _paths(hashes[tail], depth)
            one, two = (c[tail] for c in _contexts(hashes, size))
            model[tail] += (log_tail(klass, path, one, two, biases, weights) / np.log(10) + logs[hot[tail]]
                            - spread[klass * WIDTH ** depth + path.astype(np.int64)])
            listed = pa.ListArray.from_arrays(
                np.cumsum([0, *map(len, rare)]).astype(np.int32),
                pa.StructArray.from_arrays([pa.array([w for r in rare for w in r], pa.binary()),
                                            pa.array([k for r in rare for k in r.values()], pa.int32())], ["word", "n"]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(size),
                 pa.array(np.add.reduceat((hot >= 0).astype(np.int64), first)),
                 pa.array(np.add.reduceat(logs[hot], first)), pa.array(np.add.reduceat(model, first)),
                 listed],
                ["doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"])

    local = rows.select("doc_id", "held_out", "text").mapInArrow(run, SCORED.format(kind))
    local = written(local.withColumn("_row", F.monotonically_increasing_id()), "scored")
    seen = (local.select("_row", F.explode_outer("rare").alias("r")).select("_row", "r.word", "r.n")
            .where("word IS NOT NULL").join(counts, "word", "left")
            .groupBy("_row").agg(
                F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + F.lit(SMOOTH))).alias("more"),
                F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_more")))
    total = float(np.log10(n + SMOOTH * (v + 1)))
    more = F.coalesce("more", F.lit(0.0))
    return local.drop("rare").join(seen, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("model") + more).alias("score"))
