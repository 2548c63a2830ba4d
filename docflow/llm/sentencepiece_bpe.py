"""SentencePiece encoding and decoding by vectorised merge rounds.

The model file is read directly (protocol-buffer fields). Text becomes `▁`-escaped symbols with a leading `▁`, cut into
words where no piece of the vocabulary can cross: before a `▁` that follows another character and around characters
that occur in no longer piece. The distinct words of a chunk lie in one flat numpy array of piece numbers. A round
looks up the rank of every adjacent pair, takes the segmented minimum per word, merges the leftmost non-overlapping
occurrences of that pair in all words at once and compacts; rounds go on until no pair remains. Where a merged piece
could take part in a pair of equal or better rank, only the leftmost occurrence is merged in that round, which is the
order of the library's agenda. Words longer than `LONG_WORD` symbols go through an agenda (heap) of the same order,
because their rounds would be quadratic. Characters outside the vocabulary become byte pieces.

Defined results: null and empty texts have no ids and decode to the empty string; repeated rows are encoded alike;
texts are never cut; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, sha256_hex, table

SPACE = "▁"
LONG_WORD = 4096
#: Words whose encoding a worker keeps; the store is emptied when full.
CACHE_WORDS = 400_000
MODEL = "piece_bpe_32k.model"


def _fields(data: bytes):
    """(number, wire type, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value, at = data[at : at + n], at + n
        else:
            n = 4 if kind == 5 else 8
            value, at = data[at : at + n], at + n
        yield key >> 3, kind, value


class PieceModel:
    """A BPE model with byte fallback, identity normalisation and a dummy prefix."""

    NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        scores, kinds = [], []
        for number, _, value in _fields(data):
            if number == 1:
                piece, score, kind = "", 0.0, self.NORMAL
                for n, _, v in _fields(value):
                    if n == 1:
                        piece = v.decode("utf-8")
                    elif n == 2:
                        score = struct.unpack("<f", v)[0]
                    elif n == 3:
                        kind = v
                self.pieces.append(piece)
                scores.append(score)
                kinds.append(kind)
        if self.USER in kinds or self.UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.kinds = kinds
        normal = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == self.NORMAL}
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds, strict=True)) if k == self.BYTE}
        self.surface = [bytes([int(p[3:5], 16)]) if k == self.BYTE else b"" if k == self.CONTROL else " ⁇ ".encode() if k == self.UNKNOWN else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, kinds, strict=True)]
        # Equal scores are equal ranks: the agenda takes the leftmost of them.
        order = {s: r for r, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        self.rank_of = {i: order[scores[i]] for i in normal.values()}
        self.first = {p: i for p, i in normal.items() if len(p) == 1}
        # Symbols that are no piece but may be part of one get numbers after the vocabulary.
        self.symbols = dict(self.first)
        for p in normal:
            for c in p:
                self.symbols.setdefault(c, len(self.pieces) + len(self.symbols) - len(self.first))
        self.other = len(self.pieces) + len(self.symbols) - len(self.first)
        pairs, inverted = {}, set()
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = normal.get(p[:k], self.symbols.get(p[:k])), normal.get(p[k:], self.symbols.get(p[k:]))
                if a is not None and b is not None:
                    pairs[a, b] = i
                    for part in (a, b):
                        if part in self.rank_of and self.rank_of[i] <= self.rank_of[part]:
                            inverted.add(part)
        self.symbol_of = np.full(0x110000, self.other, dtype=np.int32)
        for c, i in self.symbols.items():
            self.symbol_of[ord(c)] = i
        keys = np.array([a << 32 | b for a, b in pairs], dtype=np.int64)
        by = np.argsort(keys)
        self.pair_dict = pairs
        self._index(keys[by], np.array(list(pairs.values()), dtype=np.int64)[by])
        self.rank = np.full(self.other + 1, np.iinfo(np.int32).max, dtype=np.int32)
        for i, r in self.rank_of.items():
            self.rank[i] = r
        self.one_by_one = np.zeros(self.other + 1, dtype=bool)
        self.one_by_one[list(inverted)] = True
        joined = {c for p in normal if len(p) > 1 for c in p}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal):
            raise ValueError("a piece of this model crosses a word border")
        alone = "\n" if "\n" not in joined else ""
        self.break_alone = "\n" in alone
        self.cut = re.compile(f"[{alone}]|{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" if alone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def _index(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """An open-addressing table of the pairs: one or a few gathers find a pair."""
        bits = max(4, int(len(keys)).bit_length() + 2)
        self.shift = np.uint64(64 - bits)
        size = 1 << bits
        self.slot_key = np.full(size + 64, -1, dtype=np.int64)
        self.slot_piece = np.full(size + 64, -1, dtype=np.int32)
        home = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        self.probes = 1
        for key, piece, at in zip(keys.tolist(), merged.tolist(), home.tolist(), strict=True):
            n = 1
            while self.slot_key[at] != -1:
                at, n = at + 1, n + 1
            self.slot_key[at], self.slot_piece[at] = key, piece
            self.probes = max(self.probes, n)

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        out = np.where(self.slot_key[at] == key, self.slot_piece[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.slot_key[at] != -1))
        for step in range(1, self.probes):
            if not len(open_):
                break
            there = at[open_] + step
            found = self.slot_key[there]
            hit = found == key[open_]
            out[open_[hit]] = self.slot_piece[there[hit]]
            open_ = open_[~hit & (found != -1)]
        return out

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, number of ids of each), all words together in rounds."""
        long = [k for k, w in enumerate(words) if len(w) > LONG_WORD]
        short = words if not long else [w if len(w) <= LONG_WORD else "" for w in words]
        code = np.frombuffer("".join(short).encode("utf-32-le"), dtype=np.uint32)
        word = np.repeat(np.arange(len(short), dtype=np.int32), np.fromiter(map(len, short), np.int64, len(short)))
        ids, code, word = self._rounds(self.symbol_of[code], code, word)
        rare = np.flatnonzero(ids >= len(self.pieces))
        if len(rare):
            spelt = [[self.byte_id[b] for b in chr(c).encode("utf-8")] for c in code[rare].tolist()]
            n = np.ones(len(ids), dtype=np.int64)
            n[rare] = [len(x) for x in spelt]
            ids, word = np.repeat(ids, n), np.repeat(word, n)
            at = np.cumsum(n) - n
            for k, own in zip(at[rare].tolist(), spelt, strict=True):
                ids[k : k + len(own)] = own
        counts = np.bincount(word, minlength=len(words)).astype(np.int64)
        for k in long:
            own = np.array(self._agenda(words[k]), dtype=ids.dtype)
            ids = np.insert(ids, counts[:k].sum(), own)
            counts[k] = len(own)
        return ids, counts

    def _rounds(self, sym, code, word):
        """Merge until no word has a pair left; words that are done leave the working arrays."""
        done = []
        big = np.iinfo(np.int32).max
        merged = None
        while len(sym):
            if merged is None:
                merged = np.where(word[:-1] == word[1:], self._lookup(sym[:-1], sym[1:]), -1)
            rank = np.where(merged >= 0, self.rank[merged], big)
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.minimum.reduceat(np.append(rank, big), starts)
            sizes = np.diff(np.append(starts, len(sym)))
            best_at = np.repeat(best, sizes)
            finished = best_at == big
            if finished.any():
                done.append((sym[finished], code[finished], word[finished]))
                keep = ~finished
                sym, code, word, best_at = sym[keep], code[keep], word[keep], best_at[keep]
                if not len(sym):
                    break
                # A kept word's pairs stay; the pair across a border is none anyway.
                merged, rank = np.append(merged, -1)[keep][:-1], np.append(rank, big)[keep][:-1]
            at = np.flatnonzero(rank == best_at[:-1])
            # Leftmost, not overlapping: of a chain of neighbouring positions every second one.
            chain = np.concatenate(([True], np.diff(at) != 1))
            start = at[chain][np.cumsum(chain) - 1]
            at = at[(at - start) % 2 == 0]
            single = self.one_by_one[merged[at]]
            if single.any():
                first = np.concatenate(([True], word[at][1:] != word[at][:-1]))
                # A word merges one at a time if any piece of this rank does.
                at = at[first | ~np.isin(word[at], word[at[single]])]
            sym = sym.copy()
            sym[at] = merged[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            new = np.cumsum(keep)[at] - 1
            pairs = np.append(merged, -1)
            sym, code, word = sym[keep], code[keep], word[keep]
            merged = pairs[keep][:-1]
            near = np.zeros(len(sym) + 1, dtype=bool)
            near[new] = near[new - 1] = True
            touched = np.flatnonzero(near[: len(sym) - 1])
            merged[touched] = np.where(word[touched] == word[touched + 1], self._lookup(sym[touched], sym[touched + 1]), -1)
        if not done:
            return sym, code, word
        sym, code, word = (np.concatenate(x) for x in zip(*done, strict=True))
        by = np.argsort(word, kind="stable")
        return sym[by], code[by], word[by]

    def _bytes(self, ids: list[int], codes: list[int]) -> list[int]:
        out = []
        for i, c in zip(ids, codes, strict=True):
            if i < len(self.pieces):
                out.append(i)
            else:
                out.extend(self.byte_id[b] for b in chr(c).encode("utf-8"))
        return out

    def _agenda(self, text: str) -> list[int]:
        """One very long word: a heap of (rank, position), as long as the word at most a few times."""
        get = self.symbols.get
        sym = [get(c, self.other) for c in text]
        after, before = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def put(a, b):
            if a >= 0 and b < len(sym) and (m := self.pair_dict.get((sym[a], sym[b]))) is not None:
                heapq.heappush(heap, (self.rank_of[m], a, b, m))

        for k in range(len(sym) - 1):
            put(k, k + 1)
        while heap:
            _, a, b, m = heapq.heappop(heap)
            if sym[a] < 0 or b >= len(sym) or sym[b] < 0 or after[a] != b or self.pair_dict.get((sym[a], sym[b])) != m:
                continue
            sym[a], sym[b] = m, -1
            after[a] = after[b]
            if after[a] < len(sym):
                before[after[a]] = a
            put(before[a], a)
            put(a, after[a])
        kept = [k for k, s in enumerate(sym) if s >= 0]
        return self._bytes([sym[k] for k in kept], [ord(text[k]) for k in kept])

    def words(self, text: str | None) -> list[str]:
        """The words of a text; some may be empty."""
        if not text:
            return []
        if self.break_alone and text[0] != " " and "  " not in text and SPACE not in text:
            return f"{SPACE}{text}".replace(" ", f" {SPACE}").replace("\n", " \n ").split(" ")
        return self.cut.findall(SPACE + text.replace(" ", SPACE))

    def encode(self, text: str | None) -> list[int]:
        return self.encode_words(self.words(text))[0].tolist()

    def decode(self, ids) -> str:
        """Surfaces joined; the first piece loses one leading space; broken byte runs give U+FFFD."""
        ids = [i for i in ids if self.kinds[i] != self.CONTROL]
        raw = b"".join([self.surface[i] for i in ids])
        if ids and self.pieces[ids[0]].startswith(SPACE):
            raw = raw[1:]
        return raw.decode("utf-8", errors="one-by-one")


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(Path(path).read_bytes())


def _one_by_one(e: UnicodeError):
    """A broken byte becomes one U+FFFD, and decoding goes on after it."""
    return "\ufffd", e.start + 1


codecs.register_error("one-by-one", _one_by_one)


class Codec:
    """A worker's encoder with its store of words, and vectorised decoding and digests of a chunk's texts."""

    def __init__(self, data: bytes):
        self.model = _worker_model(data)
        self.decimal = pa.array([f"{i},".encode() for i in range(len(self.model.pieces))], pa.large_binary())
        self.surface = pa.array(self.model.surface, pa.large_binary())
        self._empty()

    def _empty(self):
        self.index: dict[str, int] = {"": 0}
        self.flat, self.start, self.count = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, offsets of the texts)."""
        cut = [self.model.words(t) for t in texts]
        if len(self.index) > CACHE_WORDS:
            self._empty()
        every = list(chain.from_iterable(cut))
        new = list(set(every).difference(self.index))
        ids, counts = self.model.encode_words(new)
        self.start = np.concatenate((self.start, len(self.flat) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.flat = np.concatenate((self.flat, ids))
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        at = np.fromiter(map(self.index.__getitem__, every), np.int64, len(every))
        n = self.count[at]
        to = np.cumsum(n)
        out = self.flat[np.repeat(self.start[at] - to + n, n) + np.arange(to[-1] if len(to) else 0)]
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        return out, np.concatenate(([0], np.concatenate(([0], to))[ends]))

    def joined(self, table: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> tuple[memoryview, list[int]]:
        """The table's bytes for all ids in one buffer, and the offsets of the texts in it."""
        got = table.take(pa.array(ids))
        _, at, data = got.buffers()
        at = np.frombuffer(at, dtype=np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        return memoryview(data) if data is not None else memoryview(b""), at[offsets].tolist()

    def digests(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[list[str], list[str]]:
        """Per text: digest of the decimal list of its ids, digest of its decoded text."""
        text, at = self.joined(self.decimal, ids, offsets)
        listed = [hashlib.sha256(text[s : max(s, e - 1)]).hexdigest() for s, e in zip(at[:-1], at[1:], strict=True)]
        raw, at = self.joined(self.surface, ids, offsets)
        pieces, first = self.model.pieces, ids[np.minimum(offsets[:-1], max(0, len(ids) - 1))].tolist() if len(ids) else [0] * (len(offsets) - 1)
        decoded = []
        for s, e, f in zip(at[:-1], at[1:], first, strict=True):
            own = raw[s + 1 : e] if e > s and pieces[f][0] == SPACE else raw[s:e]
            decoded.append(sha256_hex(bytes(own).decode("utf-8", errors="one-by-one")))
        return listed, decoded


_MODELS: dict[int, PieceModel] = {}


def _worker_model(data: bytes) -> PieceModel:
    key = hash(data)
    if key not in _MODELS:
        _MODELS[key] = PieceModel(data)
    return _MODELS[key]


def _model_bytes(path: str | None) -> bytes:
    return Path(path or public_tokenizers.path(MODEL)).read_bytes()


def encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None, ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256 and, if `ids`, the ids themselves.

    The model (0.5 MB) is read on the driver and broadcast.
    """
    data = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches):
        codec = Codec(data.value)
        for b in chunks(batches, "text"):
            flat, offsets = codec.encode(col(b, "text").to_pylist())
            listed, decoded = codec.digests(flat, offsets)
            columns = [col(b, "id"), pa.array(np.diff(offsets)), pa.array(listed, pa.string()), pa.array(decoded, pa.string())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * ids]
    kinds = [T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.IntegerType())]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *[T.StructField(n, k) for n, k in zip(names[1:], kinds, strict=False)]])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, *, id_col: str = "doc_id", ids_col: str = "ids", model_path: str | None = None) -> DataFrame:
    """Per row: id and the decoded text of an array of ids (null: empty)."""
    data = tokens.sparkSession.sparkContext.broadcast(_model_bytes(model_path))

    def run(batches):
        model = _worker_model(data.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([col(b, "id"), pa.array([model.decode(x or []) for x in col(b, "ids").to_pylist()], pa.string())], ["id", "text"])

    schema = T.StructType([T.StructField("id", tokens.schema[id_col].dataType), T.StructField("text", T.StringType())])
    return tokens.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document, encoded and decoded."""
    return encode(table(spark, sf_dir, "documents"), ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
