"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, verified hits, spans or documents removed.

Words are the maximal runs of characters outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. A window
is 13 consecutive words of an item; an item of fewer words, but not none, is one window of that length. The windows
become rows of an integer matrix (word numbers), hashed by a polynomial whose multiplier is chosen so that no two
windows share a hash. A document's words are numbered by the same dictionary (unknown words break windows), all
window hashes of a chunk are computed at once, looked up, and every hit is verified word by word.

The set is broadcast if what is built of the benchmark, which is counted first (distinct words and windows), stays below
`max_broadcast_bytes`. Beyond it documents and windows meet in a join: a bit filter of fixed size, made of all windows, picks the
candidate windows of each document, the candidates alone are shuffled with their words, salted by document, and join the
windows by their words; spans and items come back by row number. Both ways give the same rows.

Defined results: a null or empty text has no words, no hits, and is not contaminated; items with a null id or null text
have no windows; repeated items and rows are judged independently; extra columns are ignored by `scan` and carried by
`decontaminate`; an empty benchmark hits nothing.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, materialise, table
from docflow.llm.near_duplicates import word_hashes

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
#: Bytes of the built set for each distinct word (dictionary entry, bytes object) and window (hash, 13 numbers, owners), measured with a margin.
WORD_BYTES, WINDOW_BYTES, ITEM_BYTES = 220, 100, 120
FILTER_BITS, SALT = 27, 16
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8").translate(_LOWER)) if text else []


class Windows:
    """The windows of benchmark items, ready for vectorised lookup: arrays, apart from the dictionary of words."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        of_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for item, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)], dtype=np.int32)
            n = min(window, len(ids))
            if n:
                of_length.setdefault(n, []).append((np.lib.stride_tricks.sliding_window_view(ids, n), number[item]))
        self.tables = []
        for n, own in sorted(of_length.items()):
            # Distinct windows in order, each with the items that hold it.
            both = np.unique(np.concatenate([np.column_stack((w, np.full(len(w), k, np.int32))) for w, k in own]), axis=0)
            new = np.concatenate(([True], (both[1:, :n] != both[:-1, :n]).any(axis=1)))
            rows, first, owner = np.ascontiguousarray(both[new, :n]), np.flatnonzero(new), np.ascontiguousarray(both[:, n])
            last = np.append(first[1:], len(both))
            factor = 0x9E3779B97F4A7C15
            while True:
                h = self._hash(rows.T, factor)
                order = np.argsort(h, kind="stable")
                if len(rows) < 2 or (np.diff(h[order].view(np.int64)) != 0).all():
                    break
                factor = (factor * 6364136223846793005 + 1442695040888963407) & (2**64 - 1) | 1
            self.tables.append((n, factor, h[order], rows[order], first[order], last[order], owner))

    @staticmethod
    def _hash(columns, factor: int) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = h * np.uint64(factor) + c.astype(np.uint64) + np.uint64(1)
        return h

    def match(self, ids: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """For word numbers (-1: unknown or a border): the hit mask, and (position, item number) of all windows found."""
        edge = np.zeros(len(ids) + 1, dtype=np.int32)
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        found = []
        for n, factor, hashes, rows, first, last, owner in self.tables:
            if len(ids) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(at):
                continue
            h = self._hash([ids[at + j] for j in range(n)], factor)
            k = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            same = hashes[k] == h
            at, k = at[same], k[same]
            right = np.ones(len(at), dtype=bool)
            for j in range(n):
                right &= ids[at + j] == rows[k, j]
            at, k = at[right], k[right]
            if len(at):
                np.add.at(edge, at, 1)
                np.add.at(edge, at + n, -1)
                many = last[k] - first[k]
                each = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                found.append((np.repeat(at, many), owner[np.repeat(first[k], many) + each]))
        return np.cumsum(edge[:-1]) > 0, found

    def scan(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """Per text: number of words, hit word ranges [start, end), items."""
        get = self.vocabulary.get
        parts, sizes = [], []
        for t in texts:
            own = [get(w, -1) for w in words(t)]
            sizes.append(len(own))
            own.append(-1)
            parts.extend(own)
        ids = np.array(parts, dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(np.array(sizes, dtype=np.int64) + 1)))
        hit, found = self.match(ids)
        items: dict[int, set[str]] = {}
        for at, k in found:
            for d, w in np.unique(np.column_stack((np.searchsorted(starts, at, side="right") - 1, k)), axis=0).tolist():
                items.setdefault(d, set()).add(self.items[w])
        out = []
        for d, n in enumerate(sizes):
            out.append((n, _ranges(hit[starts[d] : starts[d] + n]) if d in items else [], sorted(items.get(d, ()))))
        return out


def _ranges(hit: np.ndarray) -> list[tuple[int, int]]:
    """The runs of true values as [start, end)."""
    step = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True))


def _words_column(text):
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def built_bytes(items: DataFrame, window: int) -> int:
    """What the set of items (i, t) takes once built, from its counts of distinct words, windows and items."""
    own = items.select(F.col("i"), _words_column(F.col("t")).alias("w"))
    n = F.size("w")
    row = own.agg(F.count(F.lit(1)).alias("items"), F.sum(F.when(n > 0, F.greatest(n - (window - 1), F.lit(1))).otherwise(0)).alias("windows"), F.sum(F.octet_length("i")).alias("names")).first()
    vocabulary = own.select(F.explode("w").alias("w")).groupBy("w").count().agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("w")).alias("b")).first()
    return (row["items"] or 0) * ITEM_BYTES + 2 * (row["names"] or 0) + (row["windows"] or 0) * (WINDOW_BYTES + 4 * max(0, window - WINDOW)) + (vocabulary["n"] or 0) * WORD_BYTES + (vocabulary["b"] or 0)


_FOUND = "n_words long, spans array<struct<s:int,e:int>>, items array<string>"


def _annotate(frame: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, max_broadcast_bytes: int) -> DataFrame:
    """`frame` has the columns carry (any type) and text; adds n_words, spans and items."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text_col).alias("t")).where("i is not null and t is not null")
    if built_bytes(items, window) > max_broadcast_bytes:
        return _joined(frame, items, window)
    matcher = frame.sparkSession.sparkContext.broadcast(Windows([(r["i"], r["t"]) for r in items.collect()], window))

    def run(batches):
        for b in chunks(batches, "text"):
            yield _batch(b, matcher.value.scan(col(b, "text").to_pylist()))

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields[:2], *T.StructType.fromDDL(_FOUND).fields]))


def _window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all windows of n word hashes."""
    s = h[: len(h) - n + 1].copy()
    for j in range(1, n):
        s = s * np.uint64(0xD6E8FEB86659FD93) + h[j : len(h) - n + 1 + j]
    s = (s ^ (s >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return s ^ (s >> np.uint64(32))


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of a window hash in the filter."""
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _joined(frame: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """As `_annotate`, by a join of candidate windows, for sets of any size."""
    sc = frame.sparkSession.sparkContext

    def windows(batches):
        for b in chunks(batches, "t"):
            for i, t in zip(col(b, "i").to_pylist(), col(b, "t").to_pylist(), strict=True):
                own = words(t)
                n = min(window, len(own))
                if n:
                    h = _window_hashes(word_hashes(pa.array([t]))[0], n)
                    g = [b" ".join(own[k : k + n]) for k in range(len(own) - n + 1)]
                    yield pa.RecordBatch.from_arrays([pa.array([i] * len(g)), pa.array([n] * len(g), pa.int32()), pa.array(g, pa.binary()), pa.array(h.view(np.int64))], ["i", "n", "g", "h"])

    known = materialise(items.mapInArrow(windows, "i string, n int, g binary, h long").distinct(), "windows")
    sizes = [r["n"] for r in known.select("n").distinct().collect()]
    places = known.select(F.explode(F.array(F.shiftrightunsigned("h", 64 - FILTER_BITS), F.col("h").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)))).alias("p"))
    # At most 2^FILTER_BITS / 32 rows, whatever the benchmark.
    filled = places.groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 31 as int))")).alias("b")).toPandas()
    bits = np.zeros(1 << FILTER_BITS - 5, dtype=np.uint32)
    bits[filled.w.to_numpy().astype(np.int64)] = filled.b.to_numpy().astype(np.uint32)
    shared = sc.broadcast((sizes, bits))
    base = materialise(frame.withColumn("rid", F.monotonically_increasing_id()), "decontaminate")

    def candidates(batches):
        sizes, bits = shared.value
        on = lambda p: (bits[p >> 5] >> (p & 31).astype(np.uint32)) & np.uint32(1)
        for b in chunks(batches, "text"):
            h, first = word_hashes(col(b, "text"))
            of = np.repeat(np.arange(b.num_rows), np.diff(first))
            found: dict[int, list[tuple[int, int]]] = {}
            for n in sizes:
                if len(h) >= n:
                    p, q = _bits(_window_hashes(h, n))
                    for k in np.flatnonzero((on(p) & on(q) == 1) & (of[: len(p)] == of[n - 1 :])).tolist():
                        found.setdefault(int(of[k]), []).append((k - int(first[of[k]]), n))
            texts, rows = col(b, "text"), []
            for d in range(b.num_rows):
                own = words(texts[d].as_py()) if d in found else []
                rows.append([{"s": k, "n": n, "g": b" ".join(own[k : k + n])} for k, n in found.get(d, ())])
            kind = pa.list_(pa.struct([("s", pa.int32()), ("n", pa.int32()), ("g", pa.binary())]))
            yield pa.RecordBatch.from_arrays([col(b, "rid"), pa.array(np.diff(first), pa.int64()), pa.array(rows, kind)], ["rid", "n_words", "found"])

    counted = materialise(base.select("rid", "text").mapInArrow(candidates, "rid long, n_words long, found array<struct<s:int,n:int,g:binary>>"), "decontaminate")
    each = counted.select("rid", F.explode("found").alias("f")).select("rid", "f.*", F.pmod(F.xxhash64("rid"), F.lit(SALT)).alias("salt"))
    hits = each.join(known.select("i", "n", "g", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)).cast("array<long>")).alias("salt")), ["n", "g", "salt"])
    places = hits.groupBy("rid").agg(F.array_sort(F.collect_set(F.struct("s", (F.col("s") + F.col("n")).alias("e")))).alias("spans"), F.array_sort(F.collect_set("i")).alias("items"))
    # Overlapping and touching ranges become one.
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<s:int,e:int>>"),
        lambda a, x: F.when((F.size(a) > 0) & (F.element_at(a, -1)["e"] >= x["s"]), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(F.element_at(a, -1)["s"].alias("s"), F.greatest(F.element_at(a, -1)["e"], x["e"]).alias("e"))))).otherwise(F.concat(a, F.array(x))),
    )
    hit = materialise(places.select("rid", F.when(F.size("spans") > 0, merged).alias("spans"), "items"), "decontaminate")
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind)).alias(c)
    per = counted.select("rid", "n_words").join(hit, "rid", "left")
    return base.join(per, "rid").select("carry", "text", "n_words", none("spans", "array<struct<s:int,e:int>>"), none("items", "array<string>"))


def _judged(found: DataFrame, share: int) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return found.withColumn("n_hit", hit).withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def scan(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, share: int = SHARE, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items (sorted as strings), spans (hit word ranges), contaminated."""
    frame = docs.select(F.col(id_col).alias("carry"), F.col(text_col).alias("text"))
    out = _judged(_annotate(frame, benchmark, item_col, item_text_col, window, max_broadcast_bytes), share)
    return out.select(F.col("carry").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "spans", "contaminated")


def _batch(b: pa.RecordBatch, found) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))
    spans = [[{"s": x, "e": y} for x, y in s] for _, s, _ in found]
    return pa.RecordBatch.from_arrays([col(b, "carry"), col(b, "text"), pa.array([n for n, _, _ in found], pa.int64()), pa.array(spans, span), pa.array([i for _, _, i in found], pa.list_(pa.string()))], ["carry", "text", "n_words", "spans", "items"])


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the given word ranges (from the first word's start to the last word's end)."""
    raw = text.encode("utf-8")
    at = [m.span() for m in _WORD.finditer(raw.translate(_LOWER))]
    keep, pos = [], 0
    for s, e in spans:
        keep.append(raw[pos : at[s][0]])
        pos = at[e - 1][1]
    return (b"".join(keep) + raw[pos:]).decode("utf-8")


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, mode: str = "documents", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", chars_col: str | None = "n_chars", window: int = WINDOW, share: int = SHARE, max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """The documents without the contaminated ones (`mode="documents"`), or with their hit spans cut out (`"spans"`).

    All columns are carried as they are, whatever their names; other documents stay byte for byte. Where a text changes, `chars_col`, if
    the table has it, becomes its number of code points.
    """
    if mode not in ("documents", "spans"):
        raise ValueError(f"unknown mode {mode!r}")
    frame = docs.select(F.struct(*docs.columns).alias("carry"), F.col(text_col).alias("text"))
    found = _judged(_annotate(frame, benchmark, item_col, item_text_col, window, max_broadcast_bytes), share)
    if mode == "documents":
        return found.where(~F.col("contaminated")).select("carry.*")
    cut = found.mapInArrow(_cut, T.StructType([*frame.schema.fields, T.StructField("cut", T.BooleanType())]))
    new = {text_col: F.col("text")}
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        new[chars_col] = F.when(F.col("cut"), F.length("text").cast(kind)).otherwise(F.col("carry")[chars_col])
    return cut.select(*[new.get(c, F.col("carry")[c]).alias(c) for c in docs.columns])


def _cut(batches):
    for b in chunks(batches, "text"):
        change = [bool(s) and bad for s, bad in zip(col(b, "spans").to_pylist(), col(b, "contaminated").to_pylist(), strict=True)]
        new = [remove_spans(t, [(x["s"], x["e"]) for x in s]) if c else t for t, s, c in zip(col(b, "text").to_pylist(), col(b, "spans").to_pylist(), change, strict=True)]
        yield pa.RecordBatch.from_arrays([col(b, "carry"), pa.array(new, pa.string()), pa.array(change, pa.bool_())], ["carry", "text", "cut"])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark, with the digest of the items found."""
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


__all__ = ["Windows", "decontaminate", "op2_decontaminate", "remove_spans", "scan", "words"]
