"""Secret scanning with automata compiled from rules.

Each rule has three regular expressions over bytes. Its core ends where a match becomes certain to have begun. The cores of
all rules are parsed, turned into one nondeterministic automaton with a loop at its start, made deterministic by subset
construction and minimised; the result is a transition array over byte classes, with a bit for each rule. Texts are
scanned as one byte stream per batch: the stream is cut at bytes that send every state back to the start, so the
pieces can be walked side by side, one array step per byte, all rules in the same pass.

The pass tells the places where cores end. From such a place the rule's second automaton, of what leads up to it, is walked
backwards to the match's start, and its third, of the whole match, forwards from there to its end. So only matches are
read again, and no other text; spans come from automata alone.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, utf8


@dataclass(frozen=True)
class Rule:
    """kind: name in spans. core: what is searched for; for one match, cores end in the order in which matches start. lead: what
    the match holds up to the core's end, if that isn't the core. whole: the match, as long as it can be. least: characters that a
    match must have, from the core's last one on if ``value``. A match that has less is dropped, but its text is used up
    if ``spent``. fold: letters of either case.

    Expressions have literals, escapes, classes, groups, | and the marks ? * + {n} {n,}.
    """

    kind: str
    core: str
    whole: str
    lead: str = ""
    least: int = 0
    value: bool = False
    spent: bool = True
    fold: bool = False


_KEY = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]"
_PART = "[A-Za-z0-9_-]"
_PEM = r"([A-Z]+ )*PRIVATE KEY-----"

#: The base rules and the further ones.
BASE = (
    Rule("assign", f"{_KEY}{_VALUE}", f"{_KEY}{_VALUE}+", least=12, value=True, fold=True),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", least=18),
    Rule("hex", "[0-9a-f]{16}", "[0-9a-f]+", lead="[0-9a-f]+", least=16),
)
MORE = (
    Rule("private", "-----BEGIN ", f"-----BEGIN {_PEM}([^-]*-----END {_PEM})?", spent=False),
    Rule("forge", "gh[opsu]_[A-Za-z0-9]", "gh[opsu]_[A-Za-z0-9]{36,}", spent=False),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]", "xox[abprs]-[A-Za-z0-9-]{10,}", spent=False),
    Rule("jwt", rf"eyJ{_PART}*\.{_PART}", rf"eyJ{_PART}{{8,}}\.{_PART}{{8,}}\.{_PART}{{8,}}", spent=False),
)
RULES = BASE + MORE


# --- expression -> nondeterministic automaton -------------------------------------------------------------


class _Parser:
    """A small parser of the rules' expressions; makes Thompson fragments."""

    def __init__(self, fold: bool) -> None:
        self.fold = fold
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.empty: list[list[int]] = []

    def state(self) -> int:
        self.edges.append([])
        self.empty.append([])
        return len(self.edges) - 1

    def parse(self, text: str) -> tuple[int, int]:
        self.text, self.at = text, 0
        out = self.either()
        if self.at != len(text):
            raise ValueError(f"unexpected {text[self.at]!r} at {self.at} of {text!r}")
        return out

    def either(self) -> tuple[int, int]:
        parts = [self.run()]
        while self.text[self.at : self.at + 1] == "|":
            self.at += 1
            parts.append(self.run())
        if len(parts) == 1:
            return parts[0]
        a, b = self.state(), self.state()
        for s, e in parts:
            self.empty[a].append(s)
            self.empty[e].append(b)
        return a, b

    def run(self) -> tuple[int, int]:
        first = last = self.state()
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            begin = self.at
            s, e = self.atom()
            stop = self.at
            mark = self.text[stop : stop + 1]
            if mark == "{":
                close = self.text.index("}", stop)
                times, more, _ = self.text[stop + 1 : close].partition(",")
                final = s
                for _ in range(int(times) - 1):
                    self.at = begin
                    final, end = self.atom()
                    self.empty[e].append(final)
                    e = end
                if more:
                    self.empty[e].append(final)
                self.at = close + 1
            elif mark and mark in "?*+":
                self.at += 1
                x, y = self.state(), self.state()
                self.empty[x] += [s] + [y] * (mark != "+")
                self.empty[e] += [y] + [s] * (mark != "?")
                s, e = x, y
            self.empty[last].append(s)
            last = e
        return first, last

    def atom(self) -> tuple[int, int]:
        c = self.text[self.at]
        if c == "(":
            self.at += 1
            out = self.either()
            self.at += 1
            return out
        chars = self.klass() if c == "[" else {self.char()}
        if self.fold:
            chars |= {ord(chr(x).swapcase()) for x in chars if x < 128 and chr(x).isalpha()}
        a, b = self.state(), self.state()
        self.edges[a].append((frozenset(chars), b))
        return a, b

    def char(self) -> int:
        c = self.text[self.at]
        if c == "\\":
            if self.text[self.at + 1] == "x":
                self.at += 4
                return int(self.text[self.at - 2 : self.at], 16)
            self.at += 2
            return ord(self.text[self.at - 1])
        self.at += 1
        return ord(c)

    def klass(self) -> set[int]:
        self.at += 1
        out: set[int] = set()
        other = self.text[self.at] == "^"
        self.at += other
        while self.text[self.at] != "]":
            a = self.char()
            if self.text[self.at] == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                out |= set(range(a, self.char() + 1))
            else:
                out.add(a)
        self.at += 1
        return set(range(256)) - out if other else out


@dataclass
class Automaton:
    """table: next state times the number of classes, by state and class of byte; bits: rules found on entering
    a state; classes: of the 256 bytes; reset: bytes after which every state is the start."""

    table: np.ndarray
    bits: np.ndarray
    classes: np.ndarray
    reset: np.ndarray
    width: int


Edges = list[list[tuple[frozenset[int], int]]]


def _reach(empty: list[list[int]]) -> list[frozenset[int]]:
    """States that each state reaches without a byte, itself included."""
    out = []
    for v in range(len(empty)):
        seen, todo = {v}, [v]
        while todo:
            for t in empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        out.append(frozenset(seen))
    return out


def determinised(edges: Edges, empty: list[list[int]], starts: list[int], accept: dict[int, int], search: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal table (state 0 is the start), bits of states, classes of bytes: subset construction over byte classes, then
    minimisation by partition refinement. search: matches may begin anywhere."""
    reach = _reach(empty)
    sets = {c for x in edges for c, _ in x}
    signature: dict[tuple[bool, ...], int] = {}
    classes = np.array([signature.setdefault(tuple(b in c for c in sets), len(signature)) for b in range(256)], np.uint8)
    width = len(signature)
    member = [int(np.flatnonzero(classes == k)[0]) for k in range(width)]
    moves: list[list[tuple[int, ...]]] = [[tuple(t for c, t in x if member[k] in c) for k in range(width)] for x in edges]

    start = frozenset().union(*(reach[s] for s in starts))
    number = {start: 0}
    todo, rows, bits = [start], [], []
    for subset in todo:
        mask = 0
        for v in subset:
            mask |= accept.get(v, 0)
        bits.append(mask)
        row = []
        for k in range(width):
            to = set(start) if search else set()
            for v in subset:
                for t in moves[v][k]:
                    to |= reach[t]
            key = frozenset(to)
            if key not in number:
                number[key] = len(number)
                todo.append(key)
            row.append(number[key])
        rows.append(row)
    table, mask = np.array(rows, np.int64), np.array(bits, np.int64)

    group = np.unique(mask, return_inverse=True)[1]
    while True:
        _, new = np.unique(np.column_stack([group, group[table]]), axis=0, return_inverse=True)
        new = new.reshape(-1)
        if new.max() == group.max():
            break
        group = new
    order = np.full(group.max() + 1, -1)
    first = np.unique(group, return_index=True)[1]
    rank = np.argsort(first, kind="stable")
    order[rank] = np.arange(len(rank))  # the start comes first
    keep = first[rank]
    return order[group[table[keep]]], mask[keep], classes


def compile_rules(rules: tuple[Rule, ...]) -> Automaton:
    """The cores of all rules as one automaton."""
    edges: Edges = []
    empty: list[list[int]] = []
    starts, accept = [], {}
    for k, rule in enumerate(rules):
        p = _Parser(rule.fold)
        s, e = p.parse(rule.core)
        shift = len(edges)
        edges += [[(c, t + shift) for c, t in x] for x in p.edges]
        empty += [[t + shift for t in x] for x in p.empty]
        starts.append(s + shift)
        accept[e + shift] = 1 << k
    table, bits, classes = determinised(edges, empty, starts, accept, True)
    reset = np.array([(table[:, classes[b]] == 0).all() for b in range(256)])
    width = table.shape[1]
    return Automaton((table * width).astype(np.int32), bits.astype(np.int32), classes, reset, width)


class Walker:
    """An automaton of one expression that is walked from a place: onwards, or backwards over its reversal."""

    def __init__(self, expression: str, fold: bool, backwards: bool) -> None:
        p = _Parser(fold)
        s, e = p.parse(expression)
        edges, empty = p.edges, p.empty
        if backwards:
            edges, empty = [[] for _ in edges], [[] for _ in empty]
            for v, out in enumerate(p.edges):
                for c, t in out:
                    edges[t].append((c, v))
            for v, out in enumerate(p.empty):
                for t in out:
                    empty[t].append(v)
            s, e = e, s
        table, bits, classes = determinised(edges, empty, [s], {e: 1}, False)
        dead = [v for v in range(len(table)) if not bits[v] and (table[v] == v).all()]
        self.next = [[-1 if t in dead else t for t in row] for row in table[:, classes].tolist()]
        self.final = bits.astype(bool).tolist()
        self.backwards = backwards

    def reach(self, data: bytes, at: int, limit: int) -> int:
        """Backwards: the farthest start, not before the limit, of a match whose last byte is at ``at``. Onwards: the farthest end,
        not beyond the limit, of a match that starts there. -1 if there is none."""
        table, final, state, found = self.next, self.final, 0, -1
        if self.backwards:
            for k in range(at, limit - 1, -1):
                state = table[state][data[k]]
                if state < 0:
                    break
                if final[state]:
                    found = k
        else:
            for k in range(at, limit):
                state = table[state][data[k]]
                if state < 0:
                    break
                if final[state]:
                    found = k + 1
        return found


# --- scanning ----------------------------------------------------------------------------------------------


def walk(auto: Automaton, data: bytes, piece: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of the last byte) and rule bits wherever the automaton enters an accepting state."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    cls = np.frombuffer(data.translate(auto.classes.tobytes()), np.uint8)
    resets = np.flatnonzero(auto.reset[raw])
    cuts = resets[np.minimum(np.searchsorted(resets, np.arange(piece, len(raw), piece)), len(resets) - 1)] if len(resets) else resets
    starts = np.unique(np.concatenate(([0], cuts)))
    size = np.diff(np.append(starts, len(raw)))
    order = np.argsort(-size, kind="stable")
    starts, size = starts[order], size[order]
    table, bits = auto.table.ravel(), auto.bits
    accepting = bits[np.arange(len(bits))] != 0
    state = np.zeros(len(starts), np.int32)  # premultiplied by the width
    width = auto.width
    flag = np.repeat(accepting, width)
    found_at, found = [], []
    active = len(starts)
    step = 0
    longest = int(size[0])
    ends = np.searchsorted(-size, -np.arange(longest), side="left")  # pieces longer than step
    while step < longest:
        active = int(ends[step])
        if active < 4:
            break
        s = table[state[:active] + cls[starts[:active] + step]]
        state[:active] = s
        hit = flag[s]
        if hit.any():
            k = np.flatnonzero(hit)
            found_at.append(starts[k] + step)
            found.append(bits[s[k] // width])
        step += 1
    if step < longest:  # a few long pieces without a cut: byte by byte
        flat, mask = table.tolist(), bits.tolist()
        for k in range(active):
            s = int(state[k])
            begin = int(starts[k])
            at, got = [], []
            for i in range(begin + step, begin + int(size[k])):
                s = flat[s + int(cls[i])]
                if mask[s // width]:
                    at.append(i)
                    got.append(mask[s // width])
            found_at.append(np.array(at, np.int64))
            found.append(np.array(got, np.int32))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate(found_at), np.concatenate(found)


def hits(auto: Automaton, texts: list[bytes], stream: int = 1 << 22) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index, places of the last bytes of cores in order, their rule bits) of the texts with any; texts are joined into streams of
    bounded size, with a resetting byte between them."""
    gap = bytes([int(np.flatnonzero(auto.reset)[0])])
    k = 0
    while k < len(texts):
        parts, starts, size = [], [], 0
        first = k
        while k < len(texts) and (size < stream or not parts):
            starts.append(size)
            parts += [texts[k], gap]
            size += len(texts[k]) + 1
            k += 1
        at, bits = walk(auto, b"".join(parts))
        if not len(at):
            continue
        order = np.argsort(at, kind="stable")
        at, bits = at[order], bits[order]
        begin = np.array(starts)
        doc = np.searchsorted(begin, at, side="right") - 1
        cuts = np.flatnonzero(np.diff(doc, prepend=-1))
        for s, e in zip(cuts.tolist(), np.append(cuts[1:], len(doc)).tolist(), strict=True):
            yield first + int(doc[s]), at[s:e] - begin[doc[s]], bits[s:e]


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.auto = compile_rules(rules)
        self.back = [Walker(r.lead or r.core, r.fold, True) for r in rules]
        self.on = [Walker(r.whole, r.fold, False) for r in rules]

    def _matches(self, k: int, data: bytes, ends: list[int]) -> Iterator[tuple[int, int]]:
        """Leftmost matches of a rule, apart from each other, as byte places, from where its cores end."""
        rule, used, i = self.rules[k], 0, 0
        while i < len(ends):
            at = ends[i]
            i += 1
            start = self.back[k].reach(data, at, used)
            stop = self.on[k].reach(data, start, len(data)) if start >= 0 else -1
            if stop < 0:
                continue
            good = len(data[at if rule.value else start : stop].decode("utf-8", "replace")) >= rule.least
            if good:
                yield start, stop
            if good or rule.spent:
                used = stop
                i = bisect_left(ends, stop, i)

    def spans(self, texts: list[str | None]) -> dict[int, list[tuple[int, int, int]]]:
        """By index of text: (start, rule, end) in code points, sorted by start and rule."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        raw = [utf8(t) for t in texts]
        for k, at, bits in hits(self.auto, raw):
            data = raw[k]
            found = [(s, r, e) for r in range(len(self.rules)) for s, e in self._matches(r, data, at[(bits >> r & 1) == 1].tolist())]
            if found:
                if len(data) != len(texts[k]):  # bytes to code points
                    place = np.concatenate(([0], np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)))
                    found = [(int(place[s]), r, int(place[e])) for s, r, e in found]
                out[k] = sorted(found)
        return out


SPANS = "array<struct<kind:string,start:int,stop:int>>"


def find_secrets(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES, out: str = "secrets") -> DataFrame:
    """docs with a column ``out`` of spans (kind, start, stop) in code points, by start, then in the order of the
    rules. Spans of different kinds may overlap. A null or empty text has none. All rows and columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = shared.value
        for batch in batches:
            texts = list(batch)
            found = scanner.spans(texts)
            yield pd.Series([[{"kind": rules[r].kind, "start": s, "stop": e} for s, r, e in found.get(k, ())] for k in range(len(texts))])

    return docs.withColumn(free(out, docs.columns), scan(F.col("text").cast("string")))


def redact(docs: DataFrame, *, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """docs with the secrets in texts replaced: overlapping spans are joined, each becomes ``mark``. Texts without
    secrets, null and empty ones included, stay. Rows and columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = shared.value
        for batch in batches:
            texts = list(batch)
            for k, spans in scanner.spans(texts).items():
                text, out, last, reach = texts[k], [], 0, -1
                for s, _, e in spans:
                    if s >= reach:
                        out += [text[last:s], mark]
                    reach = last = max(reach, e)
                texts[k] = "".join([*out, text[last:]])
            yield pd.Series(texts)

    return docs.withColumn("text", clean(F.col("text").cast("string")))
