"""Token counts: greedy word pieces by a linear longest-match automaton, without building the pieces.

Vocabulary: the normal pieces of a SentencePiece model file; a piece that starts with `▁` may begin a word, every
other one may continue it. Words are split at white space. A word's pieces are the longest vocabulary piece at its
start, then the longest continuation, and so on; a word that cannot be covered counts as one unknown token.

The automaton is a trie of both kinds of pieces. Each node keeps a failure link, the node for what remains after its
longest pieces have been taken off (the longest piece that is a prefix of the node's string, then longest pieces of
the rest, until the rest is a trie prefix of continuations), and the number of pieces popped on the way. Reading a
character either follows a trie edge or a failure link; links only go to shorter strings, so a word takes linear time
and only counts are added up. At the word's end the counts of the remaining links are added.

Defined results: a null or empty text has no words and no tokens; repeated rows are counted alike; texts are never cut;
extra columns are ignored.
"""

from __future__ import annotations

from collections import deque
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, table
from docflow.llm.sentencepiece_bpe import SPACE, PieceModel, _model_bytes

CACHE_WORDS = 600_000


class LongestMatch:
    """`count(word)`: number of greedy longest pieces, or None where the word cannot be covered."""

    NONE = -1

    def __init__(self, first: set[str], further: set[str]):
        # Node 0: root of word starts; node 1: root of continuations.
        self.edges: list[dict[str, int]] = [{}, {}]
        self.is_piece = [False, False]
        for root, vocabulary in ((0, first), (1, further)):
            for piece in vocabulary:
                at = root
                for c in piece:
                    if c not in self.edges[at]:
                        self.edges[at][c] = len(self.edges)
                        self.edges.append({})
                        self.is_piece.append(False)
                    at = self.edges[at][c]
                self.is_piece[at] = True
        self._link()

    def _link(self) -> None:
        """Failure links in breadth-first order.

        A node that is a piece links to the continuation root with one piece popped. Another node, reached from its
        parent by c, starts from the parent's link and follows links until an edge for c exists; the pops add up.
        """
        n = len(self.edges)
        self.link, self.popped = [self.NONE] * n, [0] * n
        todo = deque(self.edges[0].items())
        parents = dict.fromkeys(self.edges[0].values(), 0)
        todo.extend(self.edges[1].items())
        parents |= dict.fromkeys(self.edges[1].values(), 1)
        while todo:
            c, v = todo.popleft()
            if self.is_piece[v]:
                self.link[v], self.popped[v] = 1, 1
            else:
                u = parents[v]
                z, pops = self.link[u], self.popped[u]
                while z != self.NONE and c not in self.edges[z]:
                    pops += self.popped[z]
                    z = self.link[z]
                if z != self.NONE:
                    self.link[v], self.popped[v] = self.edges[z][c], pops
            for d, w in self.edges[v].items():
                parents[w] = v
                todo.append((d, w))

    def count(self, word: str) -> int | None:
        edges, link, popped = self.edges, self.link, self.popped
        at = n = 0
        for c in word:
            to = edges[at].get(c)
            while to is None:
                n += popped[at]
                at = link[at]
                if at < 0:
                    return None
                to = edges[at].get(c)
            at = to
        while at != 1:
            n += popped[at]
            at = link[at]
            if at < 0:
                return None
        return n


def vocabulary(data: bytes) -> tuple[set[str], set[str]]:
    """(pieces that begin words, without their `▁`; pieces that continue words) of a model file."""
    model = PieceModel(data)
    normal = [p for p, k in zip(model.pieces, model.kinds, strict=True) if k == model.NORMAL]
    return {p[1:] for p in normal if p[0] == SPACE and len(p) > 1 and SPACE not in p[1:]}, {p for p in normal if SPACE not in p}


def count_tokens(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", model_path: str | None = None) -> DataFrame:
    """Per row: id, n_words, n_tokens (an unknown word is one token), n_unknown."""
    first, further = vocabulary(_model_bytes(model_path))
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(first, further))

    def run(batches):
        automaton = shared.value
        store: dict[str, int] = {}
        for b in chunks(batches, "text"):
            cut = [t.split() if t else [] for t in col(b, "text").to_pylist()]
            if len(store) > CACHE_WORDS:
                store = {}
            every = list(chain.from_iterable(cut))
            for w in set(every).difference(store):
                n = automaton.count(w)
                # Unknown words are marked by -1 and count as one token.
                store[w] = -1 if n is None else n
            n = np.fromiter(map(store.__getitem__, every), np.int64, len(every))
            size = np.fromiter(map(len, cut), np.int64, len(cut))
            at = np.concatenate(([0], np.cumsum(size)))
            tokens = np.concatenate(([0], np.cumsum(np.abs(n))))[at]
            unknown = np.concatenate(([0], np.cumsum(n < 0)))[at]
            yield pa.RecordBatch.from_arrays([col(b, "id"), pa.array(size), pa.array(np.diff(tokens)), pa.array(np.diff(unknown))], ["id", "n_words", "n_tokens", "n_unknown"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("n_words long, n_tokens long, n_unknown long")])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word, token and unknown counts of every document."""
    return count_tokens(table(spark, sf_dir, "documents"))
