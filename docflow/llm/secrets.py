"""Secret scans: all rules compiled into one deterministic byte automaton.

Each rule's regular expression (literals, classes, groups, alternation, ``? * + {m,n}``, case folding of ASCII
letters) becomes a Thompson NFA over bytes; the union of all rules, free to start anywhere, goes through subset
construction and partition refinement into a transition array and an array of accepted-rule bits. A chunk of texts is
scanned in one byte pass: the bytes (a separator stands between texts) are cut into lanes of equal length that step through the
transition array together, all from the start state. A lane whose predecessor ends in another state is then stepped again from that one until
it meets the states it had, which is after a few bytes as a rule; so lanes need no byte that resets the automaton.

The result, the rules that accept at each byte, gives matches: a rule that is a run of one class matches its maximal accepting runs. For
other rules the stretch between the bytes that reset all states around an accepting byte goes through two automata of the
rule alone: the reversed one marks all starts, from right to left, and the anchored one gives the longest end of the leftmost start; the
search goes on behind it. That is leftmost-longest, which for `RULES` is what a backtracking engine finds.

The body of a private key is described by what it must not hold, which the constructions do not cover, so its rule has only the first line in
the automaton; in texts with one, the body is taken by an expression.

Offsets are code points, ends exclusive. Matches that fail a rule's length test are dropped after matching.

Defined results: a null or empty text has no secrets; repeated rows are scanned alike; texts are never cut; extra
columns are ignored by `scan` and carried by `redact`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docflow.llm.common import chunks, col, table, text_buffers


@dataclass(frozen=True)
class Rule:
    """`group`: the part whose length, at least `least`, is tested; `base`: one of the base kinds.

    `mark`: where the pattern goes on without bound, what the automaton looks for instead; each match of the pattern holds one.
    """

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    base: bool = False
    mark: str = ""


_KEY = r"-----BEGIN\x20([A-Z]+\x20)*PRIVATE\x20KEY-----"
_BREAK, _BASE64 = r"(?:\r\n|\n|\r|\\r|\\n)", r"[A-Za-z0-9+/=]"
#: After a key's first line: all up to its END line or, without one, header fields and base64 that fills lines or is long. Breaks may be escaped.
_KEY_BODY = (
    r"(?:(?:(?!-----(?:BEGIN|END)\x20)(?s:.))*+-----END\x20(?:[A-Z]+\x20)*PRIVATE\x20KEY-----"
    rf"|{_BASE64}*+(?:(?:[\x20\t]*+{_BREAK})++[\x20\t]*+(?:Proc-Type|DEK-Info|Key-Info|Comment|Version):[^\r\n\\]*+)*+"
    rf"(?:(?:[\x20\t]*+{_BREAK})++[\x20\t]*+{_BASE64}++(?=[\x20\t]*+(?:[\r\n\"']|\\[nr]|\Z))|(?:[\x20\t]|{_BREAK})++{_BASE64}{{24,}}+)*+)"
)
#: The base rules come first, as listed; the others add spans.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18, 0, True),
    Rule("hex", r"[0-9a-f]+", 16, 0, True),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", 24),
    Rule("private_key", _KEY + _KEY_BODY, mark=_KEY),
)
#: All bytes of UTF-8 texts; 255 never occurs in them.
_ANY = frozenset(range(255))


class _Parser:
    """A regular expression as a tree: ("set", bytes), ("cat", parts), ("alt", parts), ("rep", part, least, most)."""

    def __init__(self, pattern: str):
        self.p, self.i, self.fold = pattern, 0, False

    def parse(self):
        tree = self._alt()
        if self.i != len(self.p):
            raise ValueError(f"cannot parse {self.p!r} at {self.i}")
        return tree

    def _peek(self):
        return self.p[self.i] if self.i < len(self.p) else ""

    def _alt(self):
        parts = [self._cat()]
        while self._peek() == "|":
            self.i += 1
            parts.append(self._cat())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _cat(self):
        parts = []
        while self._peek() and self._peek() not in "|)":
            atom = self._atom()
            while self._peek() and self._peek() in "?*+{":
                atom = ("rep", atom, *self._times())
            parts.append(atom)
        return ("cat", parts)

    def _times(self):
        c = self._peek()
        self.i += 1
        if c != "{":
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        end = self.p.index("}", self.i)
        low, comma, high = self.p[self.i : end].partition(",")
        self.i = end + 1
        return int(low), (int(high) if high else None) if comma else int(low)

    def _atom(self):
        c = self._peek()
        self.i += 1
        if c == "(":
            fold = self.fold
            if self.p.startswith("?i:", self.i):
                self.i, self.fold = self.i + 3, True
            elif self.p.startswith("?:", self.i):
                self.i += 2
            tree = self._alt()
            if self._peek() != ")":
                raise ValueError(f"unclosed group in {self.p!r}")
            self.i, self.fold = self.i + 1, fold
            return tree
        if c == "[":
            return ("set", self._class())
        if c == ".":
            return ("set", _ANY - {10})
        if c == "\\":
            c = self._escape()
        if ord(c) > 127:
            return ("cat", [("set", frozenset([b])) for b in c.encode("utf-8")])
        return ("set", self._folded({ord(c)}))

    def _escape(self):
        c = self._peek()
        self.i += 1
        if c == "x":
            self.i += 2
            return chr(int(self.p[self.i - 2 : self.i], 16))
        if c.isalnum() and c not in "nrt":
            raise ValueError(f"escape \\{c} is not supported")
        return {"n": "\n", "r": "\r", "t": "\t"}.get(c, c)

    def _class(self):
        negative = self._peek() == "^"
        self.i += negative
        out: set[int] = set()
        first = True
        while first or self._peek() != "]":
            first = False
            c = self._peek()
            self.i += 1
            if c == "\\":
                c = self._escape()
            low = high = ord(c)
            if self._peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                c = self._peek()
                self.i += 1
                high = ord(self._escape() if c == "\\" else c)
            out.update(range(low, high + 1))
        self.i += 1
        out = set(self._folded(out))
        return frozenset(_ANY - out if negative else out)

    def _folded(self, codes):
        if not self.fold:
            return frozenset(codes)
        return frozenset({*codes, *(c ^ 32 for c in codes if 65 <= c & ~32 <= 90)})


def _nfa(trees):
    """Thompson NFA of all trees: (epsilon lists, byte moves, start, accepting state -> rule)."""
    eps: list[list[int]] = []
    moves: list[tuple[frozenset[int], int] | None] = []

    def state():
        eps.append([])
        moves.append(None)
        return len(eps) - 1

    def build(tree, to):
        """The entry state of `tree` that leads to `to`."""
        kind = tree[0]
        if kind == "set":
            s = state()
            moves[s] = (tree[1], to)
            return s
        if kind == "cat":
            for part in reversed(tree[1]):
                to = build(part, to)
            return to
        if kind == "alt":
            s = state()
            eps[s] = [build(part, to) for part in tree[1]]
            return s
        _, part, low, high = tree
        if high is None:
            loop = state()
            eps[loop] = [build(part, loop), to]
            to = loop
        else:
            for _ in range(high - low):
                s = state()
                eps[s] = [build(part, to), to]
                to = s
        for _ in range(low):
            to = build(part, to)
        return to

    accepts, start = {}, state()
    for r, tree in enumerate(trees):
        end = state()
        accepts[end] = r
        eps[start].append(build(tree, end))
    return eps, moves, start, accepts


def _reversed(tree):
    """The tree of the reversed expression."""
    kind = tree[0]
    if kind == "set":
        return tree
    if kind == "cat":
        return ("cat", [_reversed(p) for p in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [_reversed(p) for p in tree[1]])
    return ("rep", _reversed(tree[1]), *tree[2:])


def _subsets(trees, free: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Subset construction: (transitions by byte class, accepted-rule bits, class of each byte, dead state or -1).

    `free`: a match may start at every byte; otherwise at the first one only, and what cannot match any more is the dead state.
    """
    eps, moves, start, accepts = _nfa(trees)

    def closure(states):
        seen, todo = set(states), list(states)
        while todo:
            for t in eps[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(seen)

    root = closure([start])
    # Bytes that no rule tells apart form a class and are expanded once.
    marks = sorted({m[0] for m in moves if m}, key=sorted)
    classes: dict[tuple[bool, ...], list[int]] = {}
    for b in range(256):
        classes.setdefault(tuple(b in m for m in marks), []).append(b)
    sets, table_, todo = {root: 0}, [], [root]
    while todo:
        own = todo.pop(0)
        row = []
        for members in classes.values():
            to = closure({moves[s][1] for s in own if moves[s] and members[0] in moves[s][0]}) | (root if free else frozenset())
            if to not in sets:
                sets[to] = len(sets)
                todo.append(to)
            row.append(sets[to])
        table_.append(row)
    bits = [sum(1 << accepts[s] for s in own if s in accepts) for own in sets]
    class_of = np.zeros(256, dtype=np.uint8)
    for k, members in enumerate(classes.values()):
        class_of[members] = k
    return np.array(table_), np.array(bits, dtype=np.uint32), class_of, sets.get(frozenset(), -1)


class Spans:
    """Leftmost-longest matches of one rule in a short stretch, by its reversed and its anchored automaton."""

    def __init__(self, tree):
        step, accept, class_of, _ = _subsets([_reversed(tree)], True)
        self.back, self.starts = [[int(row[c]) for c in class_of] for row in step], accept.astype(bool).tolist()
        step, accept, class_of, self.dead = _subsets([tree], False)
        self.ahead, self.ends = [[int(row[c]) for c in class_of] for row in step], accept.astype(bool).tolist()

    def find(self, data: bytes) -> Iterator[tuple[int, int]]:
        state, marked = 0, []
        for k in range(len(data) - 1, -1, -1):
            state = self.back[state][data[k]]
            if self.starts[state]:
                marked.append(k)
        last = 0
        for start in reversed(marked):
            if start < last:
                continue
            state, end = 0, start
            for k in range(start, len(data)):
                state = self.ahead[state][data[k]]
                if state == self.dead:
                    break
                if self.ends[state]:
                    end = k + 1
            yield start, end
            last = end


class Automaton:
    """Transition array over byte classes and accepted-rule bits of each state; state 0 is the start, to which resets return."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        if len(rules) > 32:
            raise ValueError("at most 32 rules in one automaton")
        self.rules = rules
        trees = [_Parser(r.mark or r.pattern).parse() for r in rules]
        step, bits, self.class_of, _ = _subsets(trees, True)
        if bits[0]:
            raise ValueError("a rule must not match the empty text")
        self.n_subsets, self.n_classes = step.shape
        step, accept = self._minimised(step, bits)
        self.n_states = len(accept)
        # Entries are row starts, so a step is one addition and one gather.
        self.step, self.accept = (step * self.n_classes).astype(np.int32).ravel(), accept
        self.resets = (step == 0).all(axis=0)[self.class_of]
        if not self.resets[255]:
            raise ValueError("byte 255 must end every match; it separates texts")
        self.is_run = [t[0] == "cat" and len(t[1]) == 1 and t[1][0][0] == "rep" and t[1][0][1][0] == "set" and t[1][0][2:] == (1, None) for t in trees]
        self.spans = [None if run or r.mark else Spans(t) for r, t, run in zip(rules, trees, self.is_run, strict=True)]
        self.bodies = [re.compile(r.pattern.encode("utf-8")) if r.mark else None for r in rules]
        # A tested part of a match, where it is not the whole.
        self.parts = [re.compile(r.pattern.encode("utf-8")) if r.group else None for r in rules]

    @staticmethod
    def _minimised(step: np.ndarray, accept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Partition refinement: states stay together while they accept alike and lead to the same blocks."""
        _, block = np.unique(accept, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack((block, block[step])), axis=0, return_inverse=True)
            if finer.max() == block.max():
                break
            block = finer
        # Number blocks by their first state, so that the start stays 0.
        _, first = np.unique(block, return_index=True)
        order = np.argsort(first)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        keep = first[order]
        return number[block[step[keep]]], accept[keep]

    def run(self, data: np.ndarray, lane: int = 384) -> np.ndarray:
        """The accepted-rule bits after each byte."""
        size = len(data)
        if not size:
            return np.zeros(0, dtype=np.uint32)
        lanes = -(-size // lane)
        kind = np.zeros(lanes * lane, dtype=np.uint8)
        kind[:size] = self.class_of[data]
        # Row j holds the j-th byte of every lane.
        kind = np.ascontiguousarray(kind.reshape(lanes, lane).T)
        out = np.empty((lane, lanes), dtype=np.int32)
        state = np.zeros(lanes, dtype=np.int32)
        for j in range(lane):
            state = self.step[state + kind[j]]
            out[j] = state
        begun = np.zeros(lanes, dtype=np.int32)
        while True:
            wanted = np.concatenate(([0], out[-1, :-1]))
            which = np.flatnonzero(wanted != begun)
            if not len(which):
                break
            begun[which] = state = wanted[which]
            for j in range(lane):
                state = self.step[state + kind[j, which]]
                new = state != out[j, which]
                if not new.all():
                    # The others have met their former states.
                    which, state = which[new], state[new]
                    if not len(which):
                        break
                out[j, which] = state
        return self.accept[out.T.reshape(-1)[:size] // self.n_classes]

    def _long_enough(self, r: int, text: bytes) -> bool:
        """Whether the tested part of a match of rule r reaches the rule's length."""
        rule = self.rules[r]
        if self.parts[r] is None:
            return len(text) >= rule.least
        m = self.parts[r].fullmatch(text)
        return m is not None and m.end(rule.group) - m.start(rule.group) >= rule.least

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per text: (start, rule, end) in bytes of the text, sorted by start, then rule."""
        n = len(offsets) - 1
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
        if not len(data):
            return found
        # One separator after each text.
        put = offsets[1:] + np.arange(n)
        joined = np.empty(len(data) + n, dtype=np.uint8)
        keep = np.ones(len(joined), dtype=bool)
        keep[put] = False
        joined[keep], joined[put] = data, 255
        begin = offsets[:-1] + np.arange(n)
        hit = self.run(joined)
        reset = np.flatnonzero(self.resets[joined])
        for r, rule in enumerate(self.rules):
            on = (hit >> np.uint32(r)) & np.uint32(1)
            spans = []
            if self.is_run[r]:
                edge = np.flatnonzero(np.diff(np.concatenate(([0], on.astype(np.int8), [0]))))
                s, e = edge[::2], edge[1::2]
                long = e - s >= rule.least
                spans = zip(s[long].tolist(), e[long].tolist(), strict=True)
            elif rule.mark:
                for d in np.unique(np.searchsorted(begin, np.flatnonzero(on), side="right") - 1).tolist():
                    low = int(begin[d])
                    spans += [(low + m.start(), low + m.end()) for m in self.bodies[r].finditer(joined[low : int(put[d])].tobytes()) if m.end() - m.start() >= rule.least]
            else:
                for k in np.unique(np.searchsorted(reset, np.flatnonzero(on))).tolist():
                    low = int(reset[k - 1]) + 1 if k else 0
                    text = joined[low : int(reset[k])].tobytes()
                    spans += [(low + s, low + e) for s, e in self.spans[r].find(text) if self._long_enough(r, text[s:e])]
            for s, e in spans:
                d = int(np.searchsorted(begin, s, side="right")) - 1
                found[d].append((s - int(begin[d]), r, e - int(begin[d])))
        for own in found:
            own.sort()
        return found


def spans_of(automaton: Automaton, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """Per text: (start, rule, end) in code points."""
    data, offsets = text_buffers(texts)
    found = automaton.find(data, offsets)
    for d, own in enumerate(found):
        if own:
            raw = data[offsets[d] : offsets[d + 1]]
            if (raw > 127).any():
                before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
                found[d] = [(int(before[s]), r, int(before[e])) for s, r, e in own]
    return found


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and spans, an array of (kind, start, end) by start, then rule order."""

    shared = docs.sparkSession.sparkContext.broadcast(Automaton(rules))

    def run(batches):
        automaton = shared.value
        for b in chunks(batches, "text"):
            found = spans_of(automaton, col(b, "text"))
            spans = [[{"kind": rules[r].kind, "start": s, "end": e} for s, r, e in own] for own in found]
            yield pa.RecordBatch.from_arrays([col(b, "id"), pa.array(spans, _SPAN)], ["id", "spans"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *T.StructType.fromDDL("spans array<struct<kind:string,start:int,end:int>>")])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """Overlapping spans are one; each becomes `mark`."""
    out, pos = [], 0
    for s, _, e in spans:
        if s >= pos:
            out += [text[pos:s], mark]
        pos = max(pos, e)
    return "".join(out) + text[pos:]


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, text_col: str = "text", chars_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by `mark`; texts without secrets and all other columns stay as they are.

    `chars_col`, if the table has it, holds the code points of the new text where the text changed.
    """
    k = docs.columns.index(text_col)
    n = docs.columns.index(chars_col) if chars_col in docs.columns else None

    shared = docs.sparkSession.sparkContext.broadcast(Automaton(rules))

    def run(batches):
        automaton = shared.value
        for b in chunks(batches, text_col):
            found = spans_of(automaton, b.column(k))
            if any(found):
                texts = b.column(k).to_pylist()
                new = [redact_text(t, own, mark) if own else t for t, own in zip(texts, found, strict=True)]
                kinds = b.schema
                b = b.set_column(k, kinds.field(k), pa.array(new, kinds.field(k).type))
                if n is not None:
                    sizes = [len(t) if own else old for t, own, old in zip(new, found, b.column(n).to_pylist(), strict=True)]
                    b = b.set_column(n, kinds.field(n), pa.array(sizes, kinds.field(n).type))
            yield b

    return docs.mapInArrow(run, docs.schema)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and digest of the base kinds, and all spans."""
    found = scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in RULES if r.base]
    text = F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base_text = F.transform(F.filter("spans", lambda x: x["kind"].isin(base)), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in base], F.sha2(F.array_join(base_text, ",").cast("binary"), 256).alias("base_sha256"), F.array_join(text, ",").alias("spans"))


__all__ = ["RULES", "Automaton", "Rule", "op4_secret_scan", "redact", "redact_text", "scan", "spans_of"]
