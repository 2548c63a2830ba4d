"""Language identification by language-bitmask n-gram filters.

Training: from a sample of labelled rows, bounded in rows alone (`sample_rows`, at least `least_rows` a language; texts are whole), the
character n-grams of one to four letters (case folded, other characters as word borders) are counted per language, by Spark. A
language holds the n-grams that make up at least `least_part` of its n-grams and whose relative frequency in it is at least `share` of the
highest relative frequency in any language. Each goes into Bloom filters that are bit-sliced: slot j of the one table holds bit l if
slot j of language l's filter is set, so one gather and AND per hash function returns all languages that contain an n-gram. A
language has at most 1 / `least_part` n-grams, which bounds the table; more than `max_languages` labels raise an error.

Prediction: for every n-gram position of the whole text the language mask is looked up; the population counts per
language are corrected for the false positives that the filter's fill predicts, (count - n p) / (1 - p), and the
highest decides. The score is its part of the corrected counts of all languages.

Rejection (`keep`): a language is determined if its corrected count exceeds the second's and, with the bounds of `fit(bounds=True)`, if
the part of the text's n-grams that any language holds, corrected alike, reaches the bound of the text's length class. Noise and languages
that were not learned miss it; a text in two learned languages has one that leads and stays. The bounds are `COVER_PART` of a low quantile
over labelled texts and their beginnings, each judged by filters that have not seen it.

Defined results: a text that is null or has no letter is `und` with score 0; so is every text where no language was
learned; a tie goes to the language first in order (and out of `keep`); repeated rows are judged alike; extra columns are ignored by
`predict` and carried by `keep`; labels are used in `fit` only; rows with a null id may be learned from (their remainder counts as 0).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, discard, materialise, table

UNDETERMINED = "und"
SIZES = (1, 2, 3, 4)
#: Bounds hold for texts below, between and from these numbers of n-grams; beginnings of so many characters fill the shorter classes.
EDGES, BEGINNINGS = (64, 512), (12, 60)
QUANTILE, COVER_PART = 0.02, 0.75
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """Whether a code point is a letter, built once in a process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _letters


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(letters as code points, every other run of characters as one border 1; text of each position). Each text begins with a border."""
    lowered = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join([f"\n{t}\n" for t in lowered]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.fromiter((len(t) + 2 for t in lowered), np.int64, len(texts))
    of = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    letter = _is_letter()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(sizes) - sizes] = True
    return np.where(letter, code, 1).astype(np.uint64)[keep], of[keep]


def grams(code: np.ndarray, of: np.ndarray):
    """For each size: (keys of the n-grams, their texts). No n-gram crosses texts or has a border inside."""
    for n in SIZES:
        if len(code) < n:
            continue
        key = np.full(len(code) - n + 1, n, dtype=np.uint64)
        for j in range(n):
            key = key * np.uint64(0x100000001B3) ^ code[j : len(code) - n + 1 + j]
        own = of[: len(key)] == of[n - 1 :]
        for j in range(1, n - 1):
            own &= code[j : len(key) + j] != 1
        if n <= 2:
            own &= (code[: len(key)] != 1) | (code[n - 1 :] != 1)
        yield key[own], of[: len(key)][own]


@dataclass
class Filters:
    """Bit-sliced Bloom filters of all languages."""

    languages: list[str]
    table: np.ndarray  # slots x words of 64 languages
    false_rate: np.ndarray
    bounds: np.ndarray | None = None  # the least covered part by length class

    @staticmethod
    def build(kept: dict[str, np.ndarray]) -> Filters:
        languages = sorted(kept)
        most = max([len(v) for v in kept.values()], default=0)
        bits = max(14, (12 * most).bit_length())
        words = max(1, -(-len(languages) // 64))
        slots = np.zeros((1 << bits, words), dtype=np.uint64)
        rates = np.zeros(len(languages))
        for l, name in enumerate(languages):
            keys = np.asarray(kept[name], dtype=np.uint64)
            for m in _MULTIPLIERS:
                slots[Filters._slot(keys, m, bits), l // 64] |= np.uint64(1 << l % 64)
            rates[l] = ((slots[:, l // 64] >> np.uint64(l % 64)) & np.uint64(1)).mean() ** len(_MULTIPLIERS)
        if words == 1:
            # The narrowest type that holds all languages keeps the table in the cache.
            kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if np.dtype(k).itemsize * 8 >= len(languages))
            slots = slots.astype(kind)
        return Filters(languages, slots, rates)

    def _bounded(self, bounds: np.ndarray | None) -> Filters:
        self.bounds = bounds
        return self

    @staticmethod
    def _slot(keys: np.ndarray, multiplier: int, bits: int) -> np.ndarray:
        return (keys * np.uint64(multiplier) >> np.uint64(64 - bits)).astype(np.int64)

    def masks(self, keys: np.ndarray) -> np.ndarray:
        bits = len(self.table).bit_length() - 1
        out = self.table[self._slot(keys, _MULTIPLIERS[0], bits)]
        for m in _MULTIPLIERS[1:]:
            out &= self.table[self._slot(keys, m, bits)]
        return out

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: best language or -1, corrected counts of all languages, n-grams that any language holds (corrected), n-grams."""
        code, of = _codes(texts)
        n_texts, n_lang = len(texts), len(self.languages)
        letters = np.bincount(of[code != 1], minlength=n_texts)
        count, total, held = np.zeros((n_texts, n_lang)), np.zeros(n_texts), np.zeros(n_texts)
        for key, own in grams(code, of):
            mask = self.masks(key)
            total += np.bincount(own, minlength=n_texts)
            held += np.bincount(own[(mask != 0).any(axis=1)], minlength=n_texts)
            for l in range(n_lang):
                word = mask[:, l // 64]
                on = (word >> word.dtype.type(l % 64)) & word.dtype.type(1)
                count[:, l] += np.bincount(own[on == 1], minlength=n_texts)
        if not n_lang:
            return np.full(n_texts, -1), count, np.zeros(n_texts), total
        correct = lambda c, p: np.maximum((c - total.reshape(-1, *[1] * (c.ndim - 1)) * p) / np.maximum(1 - p, 1e-9), 0)
        right = correct(count, self.false_rate)
        best = np.where(letters > 0, np.argmax(right, axis=1), -1)
        return best, right, correct(held, 1 - np.prod(1 - self.false_rate)), total

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        best, right, _, _ = self.evidence(texts)
        first, whole = right.max(axis=1, initial=0), right.sum(axis=1)
        scores = np.where((best >= 0) & (first > 0), first / np.maximum(whole, 1e-300), 0.0)
        return [UNDETERMINED if b < 0 else self.languages[b] for b in best.tolist()], scores.tolist()

    def determined(self, texts: list[str | None], least: float = 0.0) -> np.ndarray:
        """Per text: whether one language leads, with at least the score `least`, and the text is covered if there are bounds."""
        best, right, held, total = self.evidence(texts)
        if not self.languages:
            return np.zeros(len(texts), dtype=bool)
        ordered = np.sort(right, axis=1)
        first, second = ordered[:, -1], ordered[:, -2] if right.shape[1] > 1 else np.zeros(len(texts))
        out = (best >= 0) & (first > second) & (first >= least * right.sum(axis=1))
        if self.bounds is not None:
            out &= held >= self.bounds[np.searchsorted(EDGES, total, side="right")] * total
        return out


def _counted(rows: DataFrame) -> DataFrame:
    """(l, h, g, n): how often each n-gram occurs in the texts t of language l and half h."""

    def run(batches):
        for b in chunks(batches, "t", 1 << 20):
            groups: dict[tuple[str, int], list[str]] = {}
            for l, h, t in zip(col(b, "l").to_pylist(), col(b, "h").to_pylist(), col(b, "t").to_pylist(), strict=True):
                groups.setdefault((l, h), []).append(t)
            for (l, h), texts in groups.items():
                for keys, _ in grams(*_codes(texts)):
                    values, n = np.unique(keys, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([l] * len(n), pa.string()), pa.array([h] * len(n), pa.int32()), pa.array(values.view(np.int64)), pa.array(n, pa.int64())], ["l", "h", "g", "n"])

    return rows.select("l", "h", "t").mapInArrow(run, "l string, h int, g long, n long").groupBy("l", "h", "g").agg(F.sum("n").alias("n"))


def _kept(counted: DataFrame, least_part: float, share: float) -> dict[str, np.ndarray]:
    """The n-grams of each language's filter, of the columns l, g, n; languages without any are left out."""
    counted = counted.groupBy("l", "g").agg(F.sum("n").alias("n"))
    totals = counted.groupBy("l").agg(F.sum("n").alias("whole"))
    parts = counted.join(totals, "l").select("l", "g", (F.col("n") / F.col("whole")).alias("part"))
    most = parts.groupBy("g").agg(F.max("part").alias("most"))
    found = parts.where(F.col("part") >= least_part).join(most, "g").where(F.col("part") >= share * F.col("most")).select("l", "g").toPandas()
    return {str(name): own.g.to_numpy().view(np.uint64) for name, own in found.groupby("l")}


def _bounds(rows: DataFrame, judges: tuple[Filters, Filters]) -> np.ndarray:
    """The least covered part by length class, from the sampled texts and their beginnings, each judged by the other half's filters.

    Only texts whose label is found count; the driver gets one number for each. A class without any takes its neighbour's bound.
    """
    shared = rows.sparkSession.sparkContext.broadcast(judges)

    def run(batches):
        for b in chunks(batches, "t", 1 << 20):
            texts, labels, halves = (col(b, c).to_pylist() for c in "tlh")
            for n in (None, *BEGINNINGS):
                for h in (0, 1):
                    own = [k for k, t in enumerate(texts) if halves[k] == h and (n is None or len(t) > n)]
                    if not own:
                        continue
                    filters = shared.value[1 - h]
                    best, _, held, total = filters.evidence([texts[k][:n] for k in own])
                    right = np.array([i >= 0 and filters.languages[i] == labels[k] for i, k in zip(best.tolist(), own, strict=True)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(EDGES, total[right], side="right").astype(np.int32)), pa.array(held[right] / total[right])], ["c", "v"])

    found = rows.select("t", "l", "h").mapInArrow(run, "c int, v double").toPandas()
    out = np.array([np.quantile(found.v[found.c == c], QUANTILE) * COVER_PART if (found.c == c).any() else np.nan for c in range(len(EDGES) + 1)])
    for to, near in ((1, 0), (2, 1), (1, 2), (0, 1)):
        out[to] = out[near] if np.isnan(out[to]) else out[to]
    return np.nan_to_num(out)


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = 3200, max_languages: int = 1024, least_rows: int = 16, least_part: float = 2e-5, share: float = 0.35, seed: int = 7, bounds: bool = False) -> Filters:
    """Filters learned from the rows with text and label whose crc32(id as text) mod 4 is not 2.

    Every label is learned; more than `max_languages` of them raise an error, as the filters would outgrow a broadcast. About
    `sample_rows` rows are read, dealt evenly to the languages, but about `least_rows` for each at least, picked by a hash of the id. Their
    texts are whole and stay on the executors.

    With `bounds` the filters get the bounds for `keep`: the same rows, cut in two by a hash of the id, each half judged by the
    filters of the other.
    """
    key = F.col(id_col).cast("string")
    rows = docs.select(key.alias("k"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")).where(F.col("t").isNotNull() & F.col("l").isNotNull() & (F.coalesce(F.crc32(F.col("k").cast("binary")), F.lit(0)) % 4 != 2))
    sizes = rows.groupBy("l").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages are labelled")
    if not sizes:
        return Filters.build({})._bounded(np.zeros(len(EDGES) + 1) if bounds else None)
    # A fixed share of each language's rows: no sort and no shuffle of texts.
    part = F.pmod(F.xxhash64(F.lit(seed), "k"), F.lit(1_000_000))
    each = max(sample_rows / len(sizes), least_rows)
    below = {r["l"]: int(1_000_000 * min(1.0, each / r["count"])) + 1 for r in sizes}
    taken = part < F.element_at(F.map_from_arrays(F.lit(list(below)), F.lit(list(below.values()))), F.col("l"))
    half = F.pmod(F.xxhash64(F.lit(seed + 1), "k"), F.lit(2)).cast("int") if bounds else F.lit(0)
    kept: list[str] = []
    sample = materialise(rows.where(taken).select("l", half.alias("h"), "t"), "language-sample", kept)
    counted = materialise(_counted(sample), "language-grams", kept)
    filters = Filters.build(_kept(counted, least_part, share))
    if bounds:
        filters._bounded(_bounds(sample, tuple(Filters.build(_kept(counted.where(F.col("h") == h), least_part, share)) for h in (0, 1))))
    discard(docs.sparkSession, kept)
    return filters


def predict(docs: DataFrame, filters: Filters, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score; only the text is an input."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for b in chunks(batches, "text", 1 << 20):
            names, scores = shared.value.predict(col(b, "text").to_pylist())
            yield pa.RecordBatch.from_arrays([col(b, "id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("lang_pred string, score double")])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep(docs: DataFrame, filters: Filters, *, text_col: str = "text", least: float = 0.0) -> DataFrame:
    """The rows whose language is determined (see the module), with at least the score `least`; all columns are carried."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    k = docs.columns.index(text_col)

    def run(batches):
        for b in chunks(batches, text_col, 1 << 20):
            yield b.filter(pa.array(shared.value.determined(b.column(k).to_pylist(), least)))

    return docs.mapInArrow(run, docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, and whether the document was held out of training."""
    docs = table(spark, sf_dir, "documents")
    held = docs.select("doc_id", "text", (F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0)) % 4 == 2).alias("held_out"))
    filters = fit(docs)
    out = predict(held.select(F.struct("doc_id", "held_out").alias("doc_id"), "text"), filters)
    return out.select("doc_id.doc_id", "doc_id.held_out", "lang_pred", "score")
