"""Byte-level BPE encoding and decoding over a transducer lexicon.

Frequent words of the corpus are encoded once on the driver and compiled into a minimal acyclic transducer: an
automaton that shares prefixes and suffixes, whose edges carry numbers that add up to the word's place in a
list of id sequences. Workers memory-map it as one file. Words that it lacks are merged exactly, pair by pair in
rank order. Ids equal those of the tokenizers library for the same vocabulary file.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, relax, stored, worker_file

#: Fixed value: how byte-level BPE of this family splits texts into words. White space is Unicode's White_Space.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


#: Rank of a pair that doesn't merge.
NONE = np.iinfo(np.int32).max


def byte_chars() -> dict[int, str]:
    """The printable stand-in of each byte in the vocabulary file: printable Latin-1 for itself, then from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Vocabulary:
    """Pieces, merges and added tokens of a vocabulary file in the tokenizers library's JSON format."""

    def __init__(self, data: bytes) -> None:
        spec = json.loads(data)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE vocabulary")
        chars = byte_chars()
        back = {c: b for b, c in chars.items()}
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.byte_id = [vocab[chars[b]] for b in range(256)]
        self.piece: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, i in self.added.items():
            self.piece[i] = t.encode()
        names = sorted(self.added, key=len, reverse=True)
        self.split_added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.words = regex.compile(SPLIT)

    def merged(self, word: bytes) -> list[int]:
        """Ids of one word: the adjacent pair of lowest rank, leftmost first, is merged until none is left."""
        return self._long([self.byte_id[b] for b in word])

    def _long(self, ids: list[int]) -> list[int]:
        """With a heap and a linked list, for words of any length."""
        n, get = len(ids), self.merge.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m[0], k, m[1], ids[k], ids[k + 1]) for k in range(n - 1) if (m := get((ids[k], ids[k + 1])))]
        heapq.heapify(heap)
        while heap:
            _, k, new, a, b = heapq.heappop(heap)
            r = after[k]
            if ids[k] != a or r < 0 or ids[r] != b:
                continue
            ids[k], ids[r] = new, -1
            after[k] = after[r]
            if after[r] >= 0:
                before[after[r]] = k
            after[r] = -2
            for x, y in ((before[k], k), (k, after[k])):
                if x >= 0 and y >= 0 and (m := get((ids[x], ids[y]))):
                    heapq.heappush(heap, (m[0], x, m[1], ids[x], ids[y]))
        return [i for i in ids if i >= 0]


class PairTable:
    """Ranks and results of merges by pair of ids, as an open-addressing hash table in arrays."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        pairs = vocabulary.merge
        self.mask = (1 << max(4, (len(pairs) * 4).bit_length())) - 1
        self.key = np.full(self.mask + 1, -1, np.int64)
        self.rank = np.full(self.mask + 1, NONE, np.int32)
        self.result = np.zeros(self.mask + 1, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        for key, slot, (rank, new) in zip(keys.tolist(), self._slot(keys).tolist(), pairs.values(), strict=True):
            while self.key[slot] >= 0:
                slot = slot + 1 & self.mask
            self.key[slot], self.rank[slot], self.result[slot] = key, rank, new
        self.byte_id = np.array(vocabulary.byte_id, np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) & self.mask

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each pair, or that of no pair (rank NONE)."""
        keys = a << 32 | b
        slot = self._slot(keys)
        odd = np.flatnonzero((self.key[slot] != keys) & (self.key[slot] >= 0))
        while len(odd):
            slot[odd] = slot[odd] + 1 & self.mask
            odd = odd[(self.key[slot[odd]] != keys[odd]) & (self.key[slot[odd]] >= 0)]
        return slot

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words, none of them empty; all are merged side by side, in each round each word's lowest pair."""
        size = np.array([len(w) for w in words])
        ids = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        out: list[np.ndarray] = [ids[:0]] * len(words)
        while len(ids):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            last = np.append(first[1:], len(ids)) - 1
            slot = self.find(ids[:-1], ids[1:]) if len(ids) > 1 else np.zeros(0, np.int64)
            rank = np.append(self.rank[slot], NONE)
            rank[last] = NONE
            least = np.minimum.reduceat(rank, first)
            done = least == NONE
            if done.any():
                for f, e in zip(first[done].tolist(), (last[done] + 1).tolist(), strict=True):
                    out[word[f]] = ids[f:e]
            each = np.repeat(least, last - first + 1)
            go = (rank == each) & (each != NONE)
            if not go.any():
                break
            at = np.flatnonzero(go)
            # of a run of touching pairs, as in "aaaa", every second one from the left
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            ids = ids.copy()
            ids[at] = self.result[slot[at]]
            stay = each != NONE
            stay[at + 1] = False
            ids, word = ids[stay], word[stay]
        return out


# --- the lexicon -------------------------------------------------------------------------------------------


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Minimal acyclic transducer of the words as one flat file: sorted edge keys (state, byte), targets, outputs,
    final flags, then the id sequences in the words' order. Built from sorted words, states of finished
    branches being replaced by equal ones at once."""
    order = sorted(words)
    register: dict[tuple, int] = {}
    final: list[bool] = []
    edges: list[tuple[tuple[int, int], ...]] = []
    path: list[list] = [[False, []]]  # of the last word: final, edges (byte, target or None)

    def freeze(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(edges)
            final.append(node[0])
            edges.append(key[1])
        return register[key]

    last = b""
    for word in order:
        same = 0
        while same < min(len(last), len(word)) and last[same] == word[same]:
            same += 1
        for k in range(len(last), same, -1):
            node = path.pop()
            path[-1][1][-1] = (last[k - 1], freeze(node))
        for k in range(same, len(word)):
            path[-1][1].append((word[k], -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    for k in range(len(last), 0, -1):
        node = path.pop()
        path[-1][1][-1] = (last[k - 1], freeze(node))
    root = freeze(path[0])

    below: list[int] = []  # words from a state on; targets come before sources
    for f, out in zip(final, edges, strict=True):
        below.append(f + sum(below[t] for _, t in out))
    keys, targets, outputs = [], [], []
    for s, out in enumerate(edges):
        number = int(final[s])
        for b, t in out:
            keys.append(s << 8 | b)
            targets.append(t)
            outputs.append(number)
            number += below[t]
    ids = [words[w] for w in order]
    ends = np.cumsum([0] + [len(x) for x in ids])
    parts = [
        np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(outputs, "<i4"), np.array(final, "<u1"),
        np.array(ends, "<i8"), np.array([i for x in ids for i in x], "<u4"),
    ]
    head = struct.pack("<8q", root, len(keys), len(final), len(order), len(parts[-1]), 0, 0, 0)
    return head + b"".join(p.tobytes() + bytes(-p.nbytes % 8) for p in parts)


class Lexicon:
    """A compiled lexicon, mapped from its file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, edges, states, words, ids, *_ = struct.unpack_from("<8q", self.map, 0)
        at = 64
        views = []
        for kind, n in (("<i8", edges), ("<i4", edges), ("<i4", edges), ("<u1", states), ("<i8", words + 1), ("<u4", ids)):
            views.append(np.frombuffer(self.map, kind, n, at))
            at += -(-n * views[-1].itemsize // 8) * 8
        self.keys, self.targets, self.outputs, self.final, self.ends, self.ids = views

    def look_up(self, words: list[bytes]) -> np.ndarray:
        """Numbers of the words, -1 for those that aren't in; all are walked side by side, a byte at a time."""
        out = np.full(len(words), -1, np.int64)
        if not words or not len(self.keys):
            return out
        size = np.array([len(w) for w in words])
        order = np.argsort(-size, kind="stable")
        start = np.concatenate(([0], np.cumsum(size)))[:-1][order]
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        size = size[order]
        state = np.full(len(words), self.root, np.int64)
        number = np.zeros(len(words), np.int64)
        alive = np.arange(len(words))
        for step in range(int(size[0]) + 1):
            done = size[alive] == step
            if done.any():
                k = alive[done]
                k = k[self.final[state[k]] == 1]
                out[order[k]] = number[k]
            alive = alive[~done]
            if not len(alive):
                break
            key = state[alive] << 8 | data[start[alive] + step]
            e = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[e] == key
            alive, e = alive[there], e[there]
            state[alive] = self.targets[e]
            number[alive] += self.outputs[e]
        return out

    def bytes_of(self, number: int) -> bytes:
        return self.ids[self.ends[number] : self.ends[number + 1]].tobytes()


class Encoder:
    """Texts to ids (little-endian unsigned 32-bit). The lexicon answers for its words, every time; of the words that it lacks,
    those met lately are remembered, within a bound."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon, remember: int = 60_000) -> None:
        self.remember = remember
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.pairs = PairTable(vocabulary)
        self.known: dict[str, bytes] = {}
        self.special = {t: struct.pack("<I", i) for t, i in vocabulary.added.items()}
        top = max(vocabulary.piece)
        self.pieces = [vocabulary.piece.get(i, b"") for i in range(top + 1)]

    def ids_of(self, words: set[str]) -> dict[str, bytes]:
        """Packed ids of different words."""
        some = list(words)
        raw = [w.encode("utf-8", "replace") for w in some]
        number = self.lexicon.look_up(raw)
        out = {some[k]: self.lexicon.bytes_of(n) for k, n in enumerate(number.tolist()) if n >= 0}
        rest = np.flatnonzero(number < 0).tolist()
        if len(self.known) + len(rest) > self.remember:
            self.known.clear()
        known = self.known
        new = [k for k in rest if some[k] not in known]
        short = [k for k in new if len(raw[k]) <= 64]
        for k, ids in zip(short, self.pairs.merge([raw[k] for k in short]) if short else (), strict=True):
            known[some[k]] = ids.astype("<u4").tobytes()
        for k in new:
            if len(raw[k]) > 64:
                known[some[k]] = np.array(self.vocabulary.merged(raw[k]), "<u4").tobytes()
        for k in rest:
            out[some[k]] = known[some[k]]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        some = 1 << 20  # characters at a time
        out: list[bytes] = []
        k = 0
        split, find = self.vocabulary.split_added, self.vocabulary.words.findall
        while k < len(texts):
            rows: list[list] = []  # of each text: lists of words, or the ids of an added token
            size = 0
            words: set[str] = set()
            while k < len(texts) and (size < some or not rows):
                text = texts[k] or ""
                parts: list = []
                for part in split.split(text) if split else [text]:
                    if part in self.special:
                        parts.append(self.special[part])
                    elif part:
                        own = find(part)
                        words.update(own)
                        parts.append(own)
                rows.append(parts)
                size += len(text)
                k += 1
            get = self.ids_of(words).__getitem__
            out += [b"".join([p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts]) for parts in rows]
        return out

    def decode(self, ids: bytes) -> str:
        """Text of packed ids; bytes that aren't UTF-8 become U+FFFD."""
        get = self.pieces.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_encoders: dict[int, Encoder] = {}


def worker_encoder(vocabulary: bytes, lexicon: bytes, remember: int) -> Encoder:
    """The worker's encoder for these; it is made once and serves all tasks."""
    key = hash((vocabulary, lexicon, remember))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(vocabulary), Lexicon(worker_file("lexicon", lexicon)), remember)
    return _encoders[key]


#: Buckets of a count per doubling of it.
BUCKETS = 16


def frequent_words(docs: DataFrame, most: int) -> list[str]:
    """The most frequent words between spaces over all texts, ``most`` of them or a few less: all those whose counts lie in the
    highest buckets, as many buckets as fit. Counts are added up map-side first; a histogram of the buckets tells the least
    count, so no task meets more than the words that are taken. Words seen once are left out."""
    words = docs.select(F.explode(F.split(F.col("text").cast("string"), r"[\s\p{Punct}]+")).alias("w")).filter("w <> ''")
    bucket = F.floor(F.log2("count") * BUCKETS).cast("int")
    counts = stored(words.groupBy("w").count().filter("count > 1").select("w", bucket.alias("bucket")))
    least, taken = None, 0
    for row in sorted(counts.groupBy("bucket").agg(F.count("*").alias("n")).collect(), key=lambda r: -r.bucket):  # some hundreds at most
        taken += row.n
        if taken > most:
            break
        least = row.bucket
    return [] if least is None else [x.w for x in counts.filter(F.col("bucket") >= least).select("w").collect()]


def lexicon_of(vocabulary: Vocabulary, words: list[str]) -> bytes:
    """The lexicon of the words as they stand alone and behind a space."""
    parts = {part.encode("utf-8", "replace") for w in words for form in (w, f" {w}") for part in vocabulary.words.findall(form)}
    order = sorted(p for p in parts if len(p) <= 64)
    merged = PairTable(vocabulary).merge(order) if order else []
    return compile_lexicon({w: ids.tolist() for w, ids in zip(order, merged, strict=True)})


def encode(docs: DataFrame, tokenizer: str, *, lexicon_words: int = 20_000, decoded: bool = False, remember: int = 60_000, out: str = "bpe") -> DataFrame:
    """docs with a column ``out``: struct of ids (packed little-endian unsigned 32-bit integers) and, if asked for, the
    text decoded from them (else null). tokenizer: path of the vocabulary file on the driver. remember: words beyond the
    lexicon whose ids a worker keeps; more of them cost memory and save merges.

    Added tokens written in a text are encoded as such, as the tokenizers library does. A null text is encoded
    like an empty one, without ids. All rows and columns stay. The vocabulary and the lexicon, whose sizes don't
    depend on the documents, are broadcast.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        data = f.read()
    lexicon = lexicon_of(Vocabulary(data), frequent_words(docs, lexicon_words))
    shared = spark.sparkContext.broadcast((data, lexicon))

    @F.pandas_udf("ids binary, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(*shared.value, remember)
        for batch in batches:
            ids = encoder.encode(list(batch))
            yield pd.DataFrame({"ids": ids, "decoded": [encoder.decode(x) if decoded else None for x in ids]})
            relax()

    return docs.withColumn(free(out, docs.columns), run(F.col("text").cast("string")))
