"""Benchmark decontamination with a generalised suffix automaton over word ids of the test items.

Both sides are normalised alike (A-Z lower-cased, words of digits, letters and non-ASCII characters). The
automaton of all items is built once; documents are streamed through it, which gives at each word the
longest match that ends there. A match of ``window`` words, or of a whole item that is shorter, makes its
words *hit*. Nothing is shuffled: a document is read once in the task that scans it.

The items must fit an automaton in each worker, so they are cut into blocks of at most ``block_words``
words; every document is run against every block. Usually there is one. All blocks are sent to the executors, packed; a
worker unpacks one at a time and runs a whole batch of documents against it in one evaluation.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_LOWER, alnum_words, free, utf8

HIT_SCHEMA = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,stop:int>>"


class SuffixAutomaton:
    """Generalised suffix automaton: states are classes of substrings with equal occurrences in the items."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.ids: dict[bytes, int] = {}
        #: items that end in a state, for whole items shorter than the window: (words, item)
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.long_items: list[tuple[list[int], int]] = []
        self.least = window

    def _step(self, last: int, c: int) -> int:
        old = self.next[last].get(c)
        if old is not None:
            if self.length[old] == self.length[last] + 1:
                return old
            return self._clone(last, old, c)
        cur = self._new(self.length[last] + 1, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p == -1:
            self.link[cur] = 0
        else:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
        return cur

    def _new(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        clone = self._new(self.length[p] + 1, dict(self.next[q]))
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[bytes], item: int) -> None:
        """Item with index ``item``. An item without words adds nothing."""
        ids = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
        last = 0
        for c in ids:
            last = self._step(last, c)
        if ids:
            self.long_items.append((ids, item))
            self.least = min(self.least, len(ids))

    def finish(self) -> SuffixAutomaton:
        """Notes which items hold each window, at the state that the window's own text leads to."""
        self.items: dict[int, set[int]] = {}
        order = sorted(range(1, len(self.next)), key=self.length.__getitem__)
        self.cut = list(range(len(self.next)))  # of each state the ancestor that holds its text's last ``window`` words
        for v in order:
            if self.length[self.link[v]] >= self.window:
                self.cut[v] = self.cut[self.link[v]]
        for ids, item in self.long_items:
            if len(ids) < self.window:
                self.short.setdefault(self._walk(ids), []).append((len(ids), item))
            else:
                state = size = 0
                for c in ids:
                    state, size = self._advance(state, size, c)
                    if size >= self.window:
                        self.items.setdefault(self.cut[state], set()).add(item)
        self.long_items = []
        # whole short items that end wherever a state's text ends, by way of suffix links
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.next]
        for v in order:
            own = self.short.get(v, [])
            up = self.ends[self.link[v]]
            self.ends[v] = up + own if own else up
        return self

    def _walk(self, ids: list[int]) -> int:
        state = 0
        for c in ids:
            state = self.next[state][c]
        return state

    def _advance(self, state: int, size: int, c: int) -> tuple[int, int]:
        while True:
            to = self.next[state].get(c)
            if to is not None:
                return to, size + 1
            if state == 0:
                return 0, 0
            state = self.link[state]
            size = self.length[state]

    def scan(self, ids: list[int], offset: int, hits: list[tuple[int, int]], found: set[int]) -> None:
        """Streams word ids; appends [start, stop) of each window or short item met, and notes the items."""
        state = size = 0
        met: set[int] = set()  # windows whose items are noted
        window, ends, items, cut = self.window, self.ends, self.items, self.cut
        for i, c in enumerate(ids, 1):
            state, size = self._advance(state, size, c)
            most = 0
            if size >= window:
                most = window
                noted = cut[state]
                if noted not in met:
                    met.add(noted)
                    found |= items.get(noted, frozenset())
            for n, item in ends[state]:
                if n <= size:
                    found.add(item)
                    most = max(most, n)
            if most:
                hits.append((offset + i - most, offset + i))


def _merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(hits):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def matches(auto: SuffixAutomaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Hit spans of words (merged, [start, stop)) and the indexes of the items with occurring windows."""
    hits: list[tuple[int, int]] = []
    found: set[int] = set()
    n = len(words)
    if n >= auto.least and auto.ids:
        get = auto.ids.get
        ids = [get(w, 0) for w in words]
        # the automaton is at its root after a word that no item has: only runs of known words are streamed
        known = np.array(ids, np.int64) != 0
        edges = np.flatnonzero(np.diff(np.concatenate(([False], known, [False])).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        for k in np.flatnonzero(stops - starts >= auto.least).tolist():
            s, e = int(starts[k]), int(stops[k])
            auto.scan(ids[s:e], s, hits, found)
    return _merged(hits), found


def item_blocks(items: DataFrame, block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items as (id, text) in blocks of bounded size. Items stream to the driver one at a time, never all at
    once. A single item longer than a block is a block of its own."""
    block: list[tuple[str, str | None]] = []
    size = 0
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator()
    for item, text in rows:
        n = len(text or "") // 6 + 1
        if block and size + n > block_words:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += n
    yield block


def build(block: list[tuple[str, str | None]], window: int) -> tuple[SuffixAutomaton, list[str | None]]:
    auto = SuffixAutomaton(window)
    names: list[str | None] = []
    for item, text in block:
        auto.add(alnum_words(text), len(names))
        names.append(item)
    return auto.finish(), names


Built = tuple[SuffixAutomaton, list[str | None]]


class Blocks:
    """The blocks' automata for a worker. A single one stays unpacked; of several one is, at a time."""

    def __init__(self, shared: list[Broadcast]) -> None:
        self.shared = shared
        self.only: Built | None = pickle.loads(shared[0].value) if len(shared) == 1 else None

    def __iter__(self) -> Iterator[Built]:
        if self.only is not None:
            yield self.only
            return
        for b in self.shared:
            yield pickle.loads(b.value)


def _sent(items: DataFrame, window: int, block_words: int) -> list[Broadcast]:
    context = items.sparkSession.sparkContext
    return [context.broadcast(pickle.dumps(build(b, window), protocol=5)) for b in item_blocks(items, block_words)]


def contamination(
    docs: DataFrame, items: DataFrame, *, window: int = 10, block_words: int = 500_000, out: str = "contamination"
) -> DataFrame:
    """The rows of ``docs`` with a column ``out``: struct of n_words, n_hit, items (ids as strings, sorted,
    distinct) and spans (hit word ranges).

    docs: text. items: item_id, text. A null or empty text has no words and no hit; an item without words
    occurs nowhere; items with equal texts are all named; a null item_id is left out of the names but its
    words hit. Rows are kept as they are, repeated ones too. Other columns pass through, whatever their names.
    """
    shared = _sent(items, window, block_words)

    @F.pandas_udf(HIT_SCHEMA)
    def hits(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        blocks = Blocks(shared)
        for batch in texts:
            words = [alnum_words(t) for t in batch]
            spans: list[list[tuple[int, int]]] = [[] for _ in words]
            named: list[set[str]] = [set() for _ in words]
            for auto, names in blocks:
                for k, own in enumerate(words):
                    at, found = matches(auto, own)
                    spans[k] += at
                    named[k].update(names[i] for i in found if names[i] is not None)
            rows = []
            for k, own in enumerate(words):
                at = _merged(spans[k])
                rows.append((len(own), sum(e - s for s, e in at), sorted(named[k]), [{"start": s, "stop": e} for s, e in at]))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return docs.withColumn(free(out, docs.columns), hits.asNondeterministic()(F.col("text").cast("string")))  # so that it runs once for all its fields


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; a line break stands where words went."""
    if not spans:
        return text
    data = utf8(text)
    plain = data.translate(ALNUM_LOWER)
    starts, stops = [], []
    at = 0
    for w in plain.split():
        at = plain.index(w, at)
        starts.append(at)
        at += len(w)
        stops.append(at)
    out, last = [], 0
    for s, e in spans:
        out.append(data[last : starts[s]].rstrip())
        last = stops[e - 1]
    out.append(data[last:].lstrip())
    return b"\n".join(x for x in out if x).decode("utf-8")


def decontaminate(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_coverage: float = 0.5, block_words: int = 500_000
) -> DataFrame:
    """``docs`` without benchmark passages: hit spans are cut out of the texts; a document of which more than
    ``max_coverage`` of the words are hit is removed whole, and so is one of which only hit words were left.
    Cutting joins what stood around a passage; a text is searched again until no window is left in it.

    Texts without hits, null and empty ones included, stay byte for byte. All columns stay.
    """
    names = docs.columns
    shared = _sent(items, window, block_words)

    @F.pandas_udf("struct<text:string,gone:boolean>")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        blocks = Blocks(shared)
        for batch in texts:
            rows = list(batch)
            gone = [False] * len(rows)
            total = [0] * len(rows)
            left = [k for k, t in enumerate(rows) if t]
            first = True
            while left:
                hit: dict[int, list[tuple[int, int]]] = {}
                for auto, _ in blocks:
                    for k in left:
                        words = alnum_words(rows[k])
                        total[k] = len(words) if first else total[k]
                        hit.setdefault(k, []).extend(matches(auto, words)[0])
                again = []
                for k in left:
                    if spans := _merged(hit[k]):
                        if sum(e - s for s, e in spans) > max_coverage * total[k]:
                            gone[k] = True
                            continue
                        rows[k] = cut_words(rows[k], spans)
                        again.append(k)
                left, first = again, False
            yield pd.DataFrame({"text": rows, "gone": gone})

    new = free("cleaned", names)
    return (
        docs.withColumn(new, clean.asNondeterministic()(F.col("text").cast("string")))  # so that it runs once, not again for the filter
        .filter(~F.col(f"{new}.gone"))
        .select(*[F.col(f"{new}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in names])
    )

