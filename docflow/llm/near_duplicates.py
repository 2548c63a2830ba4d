"""Near-duplicate classes: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

Words are runs of letters and digits (and all characters beyond ASCII), A-Z lower-cased. A shingle is five words; a
text of fewer words, but not none, is one shingle. A shingle's weight is (1 + ln tf) * idf with idf = ln(1 + 1 / max(df / N, `RARE`)), rounded to
steps of `STEP`: from 0.75 for a shingle in all texts to 6.25 for one in at most one of 500.

The reference for df and N is the corpus with each group of near copies counted once: otherwise the shingles that the copies of a large group share
would be frequent by themselves, weigh little, and a few changed words would part the group. A text belongs to the reference if it has the
least id among the texts that share any of `FIRST_BANDS` bands of `ROWS` plain minimum hashes with it. df is counted over all rows in a sketch of
2^19 counters, and the rows outside the reference, whose texts are read again, are taken off. The sketch's error is the mean number of
shingles a document has over 2^19, a share of N that does not change with the input and lies below `RARE` for documents of 1,000 words on
average. The driver gets the counters above a share of `RARE` / 2 alone, so at most 2 / `RARE` for each shingle of a mean document.

Consistent weighted sampling draws, for each of `BANDS` x `ROWS` hash functions, Gamma(2, 1) variables r and c and a
uniform beta per shingle (by a table of 2^16 draws for each weight; in sampling alone tf is rounded down to a power of two) and keeps the shingle
with the least c / (y e^r), y = exp(r (floor(ln w / r + beta) - beta)), with floor(...) as part of the sample. Equal samples in all
rows of a band are a bucket.

Exact copies (equal word sequences) become one node, by an aggregation that combines before it shuffles. Buckets of up
to `SMALL` nodes give all their pairs; larger ones pair each node with their most central one, whose own buckets hold the most nodes (the original of
many copies, as a rule). Of a pair at least `LEAST_EQUAL` samples must agree, which one at the threshold misses once in 100,000; then it is verified
by the exact weighted Jaccard similarity of its texts, at least `THRESHOLD`, and links become classes by label propagation with pointer
jumping over written tables. Where large buckets still hold several classes, the nodes outside the most frequent class meet all nodes there, in
blocks of about `BLOCK`, in the same two steps. No group is gathered
in one task, and the pairs of a group are never listed.

Texts are shuffled only for documents that share a bucket or have copies; while their ids are few, these are broadcast and texts stay in place.

Defined results: a text that is null or has no words is a class of its own; rows that share an id are one document, near to all that any of its texts is near to, of which `deduplicate`
keeps the row with the least text (null first, then by the other columns as JSON); rows
with a null id have a null class and are always kept; ties go to the least id; extra columns are ignored by `classes`
and carried by `deduplicate`; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import CHUNK_BYTES, SMALL_ROWS, chunks, col, discard, materialise, release, spread_join, table, text_buffers

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS, FIRST_BANDS = 16, 3, 6
SKETCH_BITS, RARE, STEP = 19, 0.002, 0.25
SMALL, BLOCK, BLOCK_BYTES, LEAST_EQUAL = 8, 512, 4 << 20, 26
_TABLE_BITS = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHINGLE = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 2**64)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], dtype=np.uint8)
_IS_WORD = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 of the base and of its inverse modulo 2^64, kept in the process up to a few MB."""
    global _powers
    if len(_powers[0]) >= n:
        return _powers
    out = []
    for b in (_BASE, _INVERSE):
        p = np.full(n, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    if n <= 2 << 20:
        _powers = (out[0], out[1])
    return out[0], out[1]


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words in order, offsets of the texts in them)."""
    data, offsets = text_buffers(column)
    n = len(offsets) - 1
    # A zero byte before each text and at the end separates words of different texts.
    joined = np.zeros(len(data) + n + 1, dtype=np.uint8)
    keep = np.ones(len(joined), dtype=bool)
    keep[offsets[:-1] + np.arange(n)] = False
    keep[-1] = False
    joined[keep] = _LOWER[data]
    edge = np.diff(_IS_WORD[joined].astype(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    power, inverse = _power_tables(len(joined))
    total = np.empty(len(joined) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((joined.astype(np.uint64) + np.uint64(1)) * power[: len(joined)], out=total[1:])
    h = (total[end] - total[start]) * inverse[start]
    first = np.searchsorted(start, np.append(offsets[:-1] + np.arange(n), len(joined)))
    return _mixed(h ^ (end - start).astype(np.uint64)), first


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(text, 48-bit shingle, tf) of the distinct shingles of at most 65,535 texts, by text; and the word hashes."""
    h, first = word_hashes(column)
    n = np.diff(first)
    of = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    key = np.zeros(0, np.uint64)
    if len(h) >= WORDS:
        s = h[: len(h) - WORDS + 1].copy()
        for j in range(1, WORDS):
            s = s * _SHINGLE + h[j : len(h) - WORDS + 1 + j]
        own = of[: len(s)] == of[WORDS - 1 :]
        key = of[: len(s)][own] << np.uint64(48) | _mixed(s[own]) >> np.uint64(16)
    short = np.flatnonzero((n > 0) & (n < WORDS))
    if len(short):
        whole = []
        for d in short.tolist():
            s = np.uint64(int(n[d]))
            for w in h[first[d] : first[d + 1]]:
                with np.errstate(over="ignore"):
                    s = s * _SHINGLE + w
            whole.append(s)
        key = np.concatenate((key, short.astype(np.uint64) << np.uint64(48) | _mixed(np.array(whole, dtype=np.uint64)) >> np.uint64(16)))
    key.sort()
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(at, len(key)))
    key = key[at]
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), tf, (h, first)


def _counter(shingle: np.ndarray) -> np.ndarray:
    return (shingle * _MIX >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


class Weights:
    """Weights of shingles: 1 + ln tf times the inverse document frequency, which is kept in steps for each counter."""

    def __init__(self, counts: np.ndarray, n_docs: int):
        share = np.maximum(counts, 0) / max(1, n_docs)
        self.level = np.round(np.log1p(1 / np.maximum(share, RARE)) / STEP).astype(np.uint8)

    def idf(self, shingle: np.ndarray) -> np.ndarray:
        return self.level[_counter(shingle)] * STEP

    def of(self, shingle: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf)) * self.idf(shingle)

    def classes(self, shingle: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """What the samples tell apart: 256 * floor(log2 tf) + steps of the idf."""
        return np.floor(np.log2(tf)).astype(np.int64) * 256 + self.level[_counter(shingle)]


def _class_weight(kind: int) -> float:
    return (1 + math.log(2) * (kind >> 8)) * (kind & 255) * STEP


@lru_cache(maxsize=1)
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20_240_501))
    n = 1 << _TABLE_BITS
    return rng.gamma(2.0, 1.0, n), rng.gamma(2.0, 1.0, n), rng.random(n)


@lru_cache(maxsize=48)
def _sample_table(weight: float) -> np.ndarray:
    """For a weight: of each draw, c / (y e^r) as ordered bits in the upper half and the step t, mixed, in the lower."""
    r, c, beta = _draws()
    t = np.floor(math.log(weight) / r + beta)
    a = c / np.exp(r * (t - beta) + r)
    bits = a.astype(np.float32).view(np.uint32).astype(np.uint64)
    return bits << np.uint64(32) | (t.astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)


_ODD = [int(x) | 1 for x in np.random.Generator(np.random.PCG64(77)).integers(1 << 62, (1 << 63) - 1, (BANDS + FIRST_BANDS) * ROWS)]


def samples(weights: Weights, of: np.ndarray, shingle: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with shingles, their BANDS * ROWS samples as 32-bit numbers)."""
    start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    kind = weights.classes(shingle, tf)
    used = np.unique(kind)
    tables = np.concatenate([_sample_table(_class_weight(k)) for k in used.tolist()])
    base = np.searchsorted(used, kind) << _TABLE_BITS
    mixed = _mixed(shingle)
    low = mixed & np.uint64(0xFFFFFFFF)
    out = np.zeros((len(start), BANDS * ROWS), dtype=np.uint32)
    for k in range(BANDS * ROWS):
        at = (mixed * np.uint64(_ODD[k]) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64) + base
        out[:, k] = np.minimum.reduceat(tables[at] ^ low, start) & np.uint64(0xFFFFFFFF)
    return of[start], out


def first_samples(of: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with shingles, their FIRST_BANDS * ROWS plain minimum hashes)."""
    start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    mixed = _mixed(shingle)
    out = np.zeros((len(start), FIRST_BANDS * ROWS), dtype=np.uint32)
    for k in range(FIRST_BANDS * ROWS):
        out[:, k] = np.minimum.reduceat(mixed * np.uint64(_ODD[BANDS * ROWS + k]) >> np.uint64(32), start)
    return of[start], out


def band_keys(found: np.ndarray) -> np.ndarray:
    """The bucket keys of the bands of samples."""
    out = np.zeros((len(found), found.shape[1] // ROWS), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(found.shape[1]):
            b = k // ROWS
            out[:, b] = _mixed(out[:, b] * _SHINGLE + found[:, k] + np.uint64(k + 1))
    return out.view(np.int64)


def similarity(weights: Weights, left: pa.Array, right: pa.Array) -> np.ndarray:
    """The weighted Jaccard similarity of each pair of texts."""
    n = len(left)
    sides = []
    for side in (left, right):
        of, shingle, tf, _ = shingles(side)
        sides.append((of.astype(np.uint64) << np.uint64(48) | shingle, weights.of(shingle, tf)))
    (ka, wa), (kb, wb) = sides
    at = np.searchsorted(kb, ka)
    at[at == len(kb)] = 0
    same = kb[at] == ka if len(kb) else np.zeros(len(ka), bool)
    shared = np.bincount((ka[same] >> np.uint64(48)).astype(np.int64), np.minimum(wa[same], wb[at[same]]), minlength=n)
    total = sum(np.bincount((k >> np.uint64(48)).astype(np.int64), w, minlength=n) for k, w in sides)
    return np.where(total > shared, shared / np.maximum(total - shared, 1e-300), 0.0)


def _small(batches, column="text", rows=20_000):
    for b in chunks(batches, column):
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def _sketch(frame: DataFrame) -> DataFrame:
    """(k, n): document frequencies by counter, and the number of documents as k = -1, of the texts, each counted `times`."""

    def run(batches):
        counts, docs = np.zeros(1 << SKETCH_BITS, dtype=np.int64), 0
        for b in _small(batches):
            of, shingle, _, _ = shingles(col(b, "text"))
            times = col(b, "times").to_numpy(zero_copy_only=False)
            counts += np.bincount(_counter(shingle), times[of], minlength=len(counts)).astype(np.int64)
            docs += int(times[np.unique(of)].sum())
        at = np.flatnonzero(counts)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(counts[at], docs))], ["k", "n"])

    return frame.select("text", "times").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))


def _sampled(frame: DataFrame, weights=None) -> DataFrame:
    """id, digest of the word sequence (null without words), bytes of the text, samples: weighted ones, or plain ones without weights."""

    def run(batches):
        seen: dict[bytes, bytes] = {}
        for b in _small(batches):
            of, shingle, tf, (h, first) = shingles(col(b, "text"))
            digests = [hashlib.blake2b(h[s:e].tobytes(), digest_size=16).digest() if e > s else None for s, e in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            if len(seen) > 20_000:
                seen = {}
            # Of equal texts in a task one is sampled.
            wanted, new = np.zeros(b.num_rows, dtype=bool), set()
            for d, x in enumerate(digests):
                if x is not None and x not in seen and x not in new:
                    wanted[d] = True
                    new.add(x)
            use = wanted[of]
            if use.any():
                texts, found = samples(weights.value, of[use], shingle[use], tf[use]) if weights else first_samples(of[use], shingle[use])
                for d, k in zip(texts.tolist(), found, strict=True):
                    seen[digests[d]] = k.tobytes()
            sizes = np.diff(text_buffers(col(b, "text"))[1])
            yield pa.RecordBatch.from_arrays([col(b, "id"), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array([None if x is None else seen[x] for x in digests], pa.binary())], ["id", "digest", "size", "sample"])

    schema = T.StructType([frame.schema["id"], *T.StructType.fromDDL("digest binary, size long, sample binary")])
    return frame.select("id", "text").mapInArrow(run, schema)


def _keyed(nodes: DataFrame) -> DataFrame:
    """(id, key): the bucket keys of the nodes' samples."""

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 10_000):
                part = b.slice(k, 10_000)
                keys = band_keys(np.frombuffer(b"".join(col(part, "sample").to_pylist()), dtype=np.uint32).reshape(part.num_rows, -1))
                ids = np.repeat(col(part, "id").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.ravel())], ["id", "key"])

    return nodes.select("id", "sample").mapInArrow(run, "id long, key long")


def _nodes(signed: DataFrame) -> DataFrame:
    """One row for each word sequence: digest, least id, rows, bytes, sample."""
    return signed.where("digest is not null and id is not null").groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("size").alias("size"), F.first("sample").alias("sample"))


def _with_texts(frame: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of `frame` (id, text) whose id is in `ids` (id and further numbers, written), with these.

    Few ids are broadcast, so that texts stay in place. Beyond, a broadcast of a fixed number of id buckets keeps most other texts out of the shuffle
    while the ids fill few of them.
    """
    n = ids.count()
    if n <= SMALL_ROWS:
        return frame.join(F.broadcast(ids), "id")
    buckets = 4 * SMALL_ROWS
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    if n < buckets:
        frame = frame.join(F.broadcast(ids.select(bucket.alias("bucket")).distinct()), bucket == F.col("bucket"), "left_semi")
    return frame.join(ids.hint("merge"), "id")


def fit(frame: DataFrame, kept: list[str]) -> Weights:
    """Weights by the document frequencies of the reference (see the module); frame: id, text."""
    whole = materialise(_sketch(frame.select("text", F.lit(1).cast("long").alias("times"))), "near-sketch", kept)
    nodes = materialise(_nodes(_sampled(frame)), "near-first", kept)
    # The least text of all its buckets.
    leaders = _keyed(nodes).groupBy("key").agg(F.min("id").alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("led")).where(F.col("led") >= FIRST_BANDS)
    times = nodes.select("id", "n").join(leaders, "id", "left").select("id", (F.col("n") - F.when(F.col("led").isNull(), 0).otherwise(1)).alias("times"))
    copies = materialise(times.where("times > 0"), "near-copies", kept)
    less = _sketch(_with_texts(frame, copies))
    net = materialise(whole.unionByName(less.select("k", (-F.col("n")).alias("n"))).groupBy("k").agg(F.sum("n").alias("n")), "near-sketch", kept)
    row = net.where("k < 0").first()
    docs = max(1, row["n"] if row else 1)
    found = net.where((F.col("k") >= 0) & (F.col("n") > F.lit(RARE / 2 * docs))).toPandas()
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    counts[found.k.to_numpy()] = found.n.to_numpy()
    return Weights(counts, docs)


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) of which at least `LEAST_EQUAL` samples agree."""

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 10_000):
                part = b.slice(k, 10_000)
                sa, sb = (np.frombuffer(b"".join(col(part, c).to_pylist()), dtype=np.uint32).reshape(part.num_rows, -1) for c in ("sa", "sb"))
                yield pa.RecordBatch.from_arrays([col(part, "a"), col(part, "b")], ["a", "b"]).filter(pa.array((sa == sb).sum(axis=1) >= LEAST_EQUAL))

    side = lambda x: nodes.select(F.col("id").alias(x), F.col("sample").alias(f"s{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(run, pairs.schema).distinct()


def _slices(batches, *columns: str, limit: int = CHUNK_BYTES, rows: int = 2_000):
    """Slices of the batches with at most `limit` bytes in the columns together; a longer row comes alone."""
    try:
        for b in batches:
            at = sum(text_buffers(col(b, c))[1] for c in columns)
            start = 0
            while start < b.num_rows:
                end = min(start + rows, max(start + 1, int(np.searchsorted(at, at[start] + limit, side="right")) - 1))
                yield b.slice(start, end - start)
                start = end
    finally:
        release()


def _verified(pairs: DataFrame, texts: DataFrame, weights, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""

    def run(batches):
        for b in _slices(batches, "ta", "tb"):
            good = similarity(weights.value, col(b, "ta"), col(b, "tb")) >= threshold
            yield pa.RecordBatch.from_arrays([col(b, "a"), col(b, "b")], ["a", "b"]).filter(pa.array(good))

    # Merge joins at every size: a hub's pairs can be split, and the shuffle stays in proportion to the input.
    left, right = texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, pairs.select("a", "b").schema)


def components(edges: DataFrame, kept: list[str] | None = None, tag: str = "near-labels") -> DataFrame:
    """(id, label) of all nodes of the edges (a, b): the least id of the connected component.

    Each round takes the least label of the neighbours and then the label's own label; rounds go on until none changes.
    Labels and edges are written tables, so a join may split a hub's edges, and minima combine before they shuffle.
    """
    both = edges.select(F.col("a").alias("id"), F.col("b").alias("to")).unionByName(edges.select(F.col("b").alias("id"), F.col("a").alias("to")))
    labels = materialise(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("label")), tag, kept)
    while True:
        near = both.join(labels.select(F.col("id").alias("to"), F.col("label").alias("l")), "to").select("id", "l").groupBy("id").agg(F.min("l").alias("l"))
        next_ = materialise(labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "l").alias("label")), tag, kept)
        jump = next_.select(F.col("id").alias("label"), F.col("label").alias("l"))
        labels = materialise(next_.join(jump, "label").select("id", "old", F.least("label", "l").alias("label")), tag, kept)
        if labels.where("label < old").isEmpty():
            return labels.select("id", "label")
        labels = labels.select("id", "label")


def _shared(weights: Weights, left: tuple, right: tuple, n_left: int, n_right: int) -> np.ndarray:
    """The matrix of shared weights of two sets of texts.

    A weight is the sum of its steps, idf for the first occurrence and idf * ln(t / (t - 1)) for the t-th, so the lesser of two weights is the sum of the
    steps that both have; these are features of their own, and shared features come from matrix products over a few thousand at a time.
    """
    sides = []
    for of, shingle, tf in (left, right):
        at = np.repeat(np.arange(len(of)), tf)
        step = np.arange(len(at)) - np.repeat(np.cumsum(tf) - tf, tf) + 1
        sides.append((of[at], _mixed(shingle[at] * _MIX + step.astype(np.uint64)), shingle[at], step))
    both = np.intersect1d(sides[0][1], sides[1][1])
    out = np.zeros((n_left, n_right), dtype=np.float64)
    if not len(both):
        return out
    place = []
    for of, key, shingle, step in sides:
        k = np.minimum(np.searchsorted(both, key), len(both) - 1)
        hit = both[k] == key
        place.append((of[hit], k[hit], shingle[hit], step[hit]))
    gain = np.zeros(len(both))
    _, k, shingle, step = place[0]
    gain[k] = weights.idf(shingle) * np.where(step == 1, 1.0, np.log(step / np.maximum(step - 1, 1)))
    width = 4096
    orders = [np.argsort(p[1], kind="stable") for p in place]
    for low in range(0, len(both), width):
        a, b = np.zeros((n_left, width), np.float64), np.zeros((n_right, width), np.float64)
        for m, (of, k, _, _), order in zip((a, b), place, orders, strict=True):
            own = order[np.searchsorted(k[order], low) : np.searchsorted(k[order], low + width)]
            m[of[own], k[own] - low] = 1
        a[:, : min(width, len(both) - low)] *= gain[low : low + width]
        out += a @ b.T
    return out


def _linked(large: DataFrame, open_: DataFrame, nodes: DataFrame, frame: DataFrame, weights, threshold: float, kept: list[str]) -> DataFrame:
    """Links (a, b) between classes that share large buckets, found in blocks.

    large: key, id, label; open_: key and the least label of buckets with several classes. Buckets of the same least label
    form a cluster. Its nodes outside the most frequent class meet all its nodes, in blocks of about `BLOCK` nodes and `BLOCK_BYTES` of text: by
    their samples, then, where these allow a link, by their texts. A task gives at most one link for a node and another class.
    """
    rows = spread_join(large.drop("n"), open_, "key", "n", ["id"], per_task=1_000).select("cluster", "id", "label").distinct()
    rows = materialise(rows.join(nodes.select("id", "size", "sample"), "id"), "near-rest", kept)
    per = rows.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES, F.lit(1.0))).cast("int")
    sizes = per.groupBy("cluster").agg(F.max(F.struct("n", F.col("bytes"), "label")).alias("m"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    sizes = materialise(sizes.select("cluster", F.col("m.label").alias("main"), blocks(F.col("n"), F.col("bytes")).alias("ni"), blocks(F.col("n") - F.col("m.n"), F.col("bytes") - F.col("m.bytes")).alias("nj")), "near-sizes", kept)
    own = rows.join(sizes, "cluster")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    node = ["id", "label", "sample"]
    left = own.select("cluster", part("ni").alias("i"), each("nj").alias("j"), F.lit(True).alias("all"), *node)
    right = own.where("label != main").select("cluster", each("ni").alias("i"), part("nj").alias("j"), F.lit(False).alias("all"), *node)
    cells = "cluster long, i int, j int, `all` boolean, id long, label long"

    def likely(t: pa.Table) -> pa.Table:
        """The nodes of a cell with a partner of another label whose samples agree often enough."""
        mask = t["all"].to_numpy()
        sides = [t.filter(pa.array(m)) for m in (mask, ~mask)]
        found = [np.frombuffer(b"".join(s["sample"].to_pylist()), dtype=np.uint32).reshape(s.num_rows, -1) for s in sides if s.num_rows]
        if len(found) < 2:
            return t.slice(0, 0).drop_columns(["sample"])
        equal = np.zeros((len(found[0]), len(found[1])), dtype=np.uint8)
        for k in range(found[0].shape[1]):
            equal += found[0][:, k, None] == found[1][None, :, k]
        labels = [s["label"].to_numpy() for s in sides]
        good = (equal >= LEAST_EQUAL) & (labels[0][:, None] != labels[1][None, :])
        return pa.concat_tables([s.filter(pa.array(good.any(axis=1 - k))) for k, s in enumerate(sides)]).drop_columns(["sample"])

    candidates = materialise(left.unionByName(right).groupBy("cluster", "i", "j").applyInArrow(likely, cells), "near-cells", kept)

    def run(t: pa.Table) -> pa.Table:
        mask = t["all"].to_numpy()
        sides = [t.filter(pa.array(mask)), t.filter(pa.array(~mask))]
        a, b = [], []
        if sides[0].num_rows and sides[1].num_rows:
            w = weights.value
            found = [shingles(s["text"].combine_chunks()) for s in sides]
            total = [np.bincount(f[0], w.of(f[1], f[2]), minlength=s.num_rows) for f, s in zip(found, sides, strict=True)]
            shared = _shared(w, found[0][:3], found[1][:3], sides[0].num_rows, sides[1].num_rows)
            good = shared >= threshold * (total[0][:, None] + total[1][None, :] - shared) - 1e-9
            ids, labels = [s["id"].to_numpy() for s in sides], [s["label"].to_numpy() for s in sides]
            good &= labels[0][:, None] != labels[1][None, :]
            seen = set()
            for i, j in zip(*np.nonzero(good), strict=True):
                key = (int(labels[0][i]), int(ids[1][j]))
                if key not in seen:
                    seen.add(key)
                    a.append(min(int(ids[0][i]), int(ids[1][j])))
                    b.append(max(int(ids[0][i]), int(ids[1][j])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    texts = materialise(_with_texts(frame, materialise(candidates.select("id").distinct(), "near-wanted", kept)), "near-texts", kept)
    return candidates.join(texts.hint("merge"), "id").groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long").distinct()


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id and class_id, the least id of its near-duplicate class. Ids are integers."""
    sc, kept = docs.sparkSession.sparkContext, []
    frame = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    weights = sc.broadcast(fit(frame, kept))
    signed = materialise(_sampled(frame, weights), "near-signed", kept)
    nodes = materialise(_nodes(signed), "near-nodes", kept)
    keyed = _keyed(nodes)
    buckets = materialise(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-buckets", kept)
    members = materialise(spread_join(keyed, buckets.withColumn("rows", F.col("n")), "key", "rows", ["id"], per_task=1_000), "near-members", kept)
    few = members.where(F.col("n") <= SMALL).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    few = few.select("ids", F.explode("ids").alias("a")).select("a", F.explode("ids").alias("b")).where("a < b")
    crowded = members.where(F.col("n") > SMALL)
    central = crowded.join(crowded.groupBy("id").agg(F.sum("n").alias("near")), "id").groupBy("key").agg(F.max_by("id", F.struct("near", -F.col("id"))).alias("leader"), F.first("n").alias("n"))
    many = spread_join(crowded.select("id", "key"), central, "key", "n", ["id"], per_task=1_000).where("id != leader").select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
    pairs = materialise(_likely(few.unionByName(many).distinct(), nodes), "near-pairs", kept)
    wanted = materialise(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "near-wanted", kept)
    texts = _with_texts(frame, wanted)
    texts = materialise(texts.distinct() if _repeats(signed) else texts, "near-texts", kept)
    edges = materialise(_verified(pairs, texts, weights, threshold), "near-edges", kept)
    labels = components(edges, kept)
    large = crowded.join(labels, "id", "left").select("key", "n", "id", F.coalesce("label", "id").alias("label"))
    open_ = materialise(large.groupBy("key").agg(F.min("label").alias("cluster"), F.max("label").alias("m"), F.first("n").alias("n")).where("cluster < m").select("key", "cluster", "n"), "near-open", kept)
    if not open_.isEmpty():
        more = materialise(_linked(large, open_, nodes, frame, weights, threshold, kept), "near-edges", kept)
        if not more.isEmpty():
            labels = components(edges.unionByName(more), kept)
    named = materialise(nodes.select("digest", "id", "n").join(labels, "id", "left").select("digest", "n", F.coalesce("label", "id").alias("class_id")), "near-classes", kept)
    alone = signed.where("digest is null or id is null").select("id", F.col("id").alias("class_id"))
    grouped = spread_join(signed.where("digest is not null and id is not null").select("digest", "id"), named, "digest", "n", ["id"], per_task=10_000).select("id", "class_id")
    out = materialise(grouped.unionByName(alone), "near-result")
    discard(docs.sparkSession, kept)
    return out.withColumnRenamed("id", id_col)


def _repeats(signed: DataFrame) -> bool:
    """Whether rows share an id."""
    return not signed.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with the least id of their class, one row each, and all rows with a null id; all columns are carried."""
    found = classes(docs, id_col=id_col, text_col=text_col, threshold=threshold).where(F.col(id_col).isNotNull())
    state = found.groupBy(F.col(id_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n"), F.min(F.col("class_id")).alias("__class"))
    # Ids that go, and ids of several rows, of which one stays.
    touched = materialise(state.where("__n > 1 or __class != __id").select("__id", (F.col("__class") == F.col("__id")).alias("__one")), "near-touched")
    few = touched.count() <= SMALL_ROWS
    hint = F.broadcast if few else (lambda t: t.hint("merge"))
    key = docs[id_col].cast("long")
    rest = docs.join(hint(touched), key == touched["__id"], "left_anti")
    again = touched.where("__one").select("__id")
    if again.isEmpty():
        return rest
    rows = docs.join(hint(again), key == again["__id"], "left_semi")
    order = Window.partitionBy(id_col).orderBy(F.col(text_col).asc_nulls_first(), F.to_json(F.struct(*docs.columns)))
    once = rows.withColumn("__k", F.row_number().over(order)).where(F.col("__k") == 1).drop("__k")
    return rest.unionByName(once)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return classes(table(spark, sf_dir, "documents"))
