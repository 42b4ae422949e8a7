"""Shared helpers of the training-data operators: words, hashes, checkpoints and streamed groups."""

from __future__ import annotations

import ctypes
import json
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.session import checkpointed, ship

_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_UPPER = bytes(range(0x41, 0x5B))
ASCII_LOWER = bytes.maketrans(_UPPER, _UPPER.lower())
#: A-Z become a-z, every other ASCII character outside 0-9a-z becomes a space; bytes of non-ASCII characters stay.
ALNUM_LOWER = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 0x20 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, lone surrogates are replaced."""
    return b"" if text is None else text.encode("utf-8", "replace")


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words of digits, a-z and non-ASCII characters."""
    return utf8(text).translate(ALNUM_LOWER).split()


def space_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space and 0x09-0x0D)."""
    return utf8(text).split()


def lower_space_words(text: str | None) -> list[bytes]:
    """The same with A-Z in lower case."""
    return utf8(text).translate(ASCII_LOWER).split()


class WordHash(dict):
    """Word to 64-bit hash, remembered; forgets everything beyond a bound so that memory stays flat."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (fixed constants of the public SplitMix64 generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes beyond which a word is hashed alone.
LONG_WORD = 256
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\v\f\r", np.uint8))


def word_hashes(texts: Iterable[str | None]) -> list[np.ndarray]:
    """64-bit hashes of the words of each text, as ``lower_space_words`` tells them; made eight bytes at a time of all words at once."""
    cells = [utf8(t) for t in texts]
    if not cells:
        return []
    data = b" ".join([b"", *cells, b""]).translate(ASCII_LOWER)
    space = _SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, size = edges[::2], edges[1::2] - edges[::2]
    chunks = np.ndarray(len(data), "<u8", data + bytes(8), strides=(1,))
    out = mix(size.astype(np.uint64))
    left = np.flatnonzero(size <= LONG_WORD)
    at = 0
    while len(left):
        rest = size[left] - at
        part = chunks[start[left] + at]
        short = rest < 8
        part[short] &= (np.uint64(1) << (8 * rest[short]).astype(np.uint64)) - np.uint64(1)
        out[left] = mix(out[left] + part)
        left, at = left[rest > 8], at + 8
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[start[k] : start[k] + size[k]])
    stops = np.cumsum([len(c) + 1 for c in cells])
    return np.split(out, np.searchsorted(start, stops[:-1]))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of each run of k words, in order. Fewer words than k, but not none, make one shingle."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        out = np.full(1, n, np.uint64)
        for i in range(n):
            out = mix(out + words[i])
        return out
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out + words[i : n - k + 1 + i])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in spark.checkpoint.dir. Only on one machine, as in tests, may that be
    unset; on a cluster it is an error."""
    ship(df.sparkSession)
    return checkpointed(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table of the driver's rows. It is parsed by the executors themselves: making it from Python objects would start
    another pool of Python workers that stays."""
    kind = spark.range(0).select(F.from_json(F.lit("{}"), schema).alias("x")).schema["x"].dataType
    data = json.dumps([dict(zip(kind.names, row, strict=True)) for row in rows], ensure_ascii=False)
    return spark.range(1).select(F.explode(F.from_json(F.lit(data), T.ArrayType(kind))).alias("x")).select("x.*")


def stream_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of rows with equal keys from batches that come sorted by keys; holds one group at a time."""
    rest: list[pd.DataFrame] = []
    last: tuple | None = None
    for batch in batches:
        if not len(batch):
            continue
        values = [batch[k].to_numpy() for k in keys]
        change = np.zeros(len(batch), bool)
        change[0] = True
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], len(batch))
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            key = tuple(v[s] for v in values)
            if last is not None and key != last:
                yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]
                rest = []
            last = key
            rest.append(batch.iloc[s:e])
    if rest:
        yield pd.concat(rest, ignore_index=True) if len(rest) > 1 else rest[0]


def relax() -> None:
    """Gives memory that this worker's allocators hold unused back to the machine."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def free(name: str, taken: list[str]) -> str:
    """A column name that none of the taken ones clashes with, whatever their case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def worker_file(name: str, data: bytes) -> str:
    """Path of a file with these bytes in the worker's temporary folder; written once and only ever read."""
    path = os.path.join(tempfile.gettempdir(), f"{name}-{xxhash.xxh3_64_hexdigest(data)}")
    if not os.path.exists(path):
        os.makedirs(tempfile.gettempdir(), exist_ok=True)
        part = f"{path}.{os.getpid()}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, path)
    return path
