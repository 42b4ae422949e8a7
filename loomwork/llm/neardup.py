"""Near-duplicate documents by MinHash banding, verification on full shingle sets and connected components.

1. One pass over the texts gives each document the minima of ``bands * rows`` universal hash functions over its
   shingles: a signature of 16 bits each, and one key per band. Equal texts are folded into one representative.
2. Documents that share a band key are linked to the smallest document of the bucket: as many links as bucket
   members. Large-star/small-star turns these into coarse groups. Any two similar documents share a band
   (with 32 bands of 4 all but 5 in 10^8 pairs at similarity 0.8, 5 in 10^11 at 0.85), so they lie in one coarse group.
3. Coarse groups are refined by signatures alone, in blocks: documents whose signatures agree as those of similar ones do (six
   standard deviations below the threshold) stay together. A chain of loosely similar documents falls apart here, before
   any text moves.
4. The texts of what is left are shuffled once, each to its group's smallest document, whose text is sent along. Those that are
   similar to it are joined. Only the others, the open ones, are held against all of their group: groups are cut into blocks
   of at most ``block`` documents, and each pair of an open block with any block is a task, so memory is bounded. Signatures are
   compared first, then full sets; of the links found, those that join parts not joined yet are kept.
5. The kept links are connected again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHash, lower_space_words, mix, relax, shingle_hashes, shuffle_partitions, signed, stored, stream_groups
from .components import components, keyed_join

#: Documents whose ids may be sent to every task to pick texts out of the table; beyond, texts are joined by shuffling. The operator
#: sends ids alone, as rows with text keys fill the driver's memory.
MOST_SENT = 500_000

#: Signatures (of 256 bytes) in a block: two blocks are compared in a task.
SIGNATURES = 4096


class MinHash:
    """Minima of universal hash functions (a * x + b, top bits) over shingle sets."""

    def __init__(self, count: int, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, count, np.uint64) * np.uint64(2)

    def minima(self, shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Rows per set (sets begin at ``starts``, none is empty), columns per function; 32 bits each."""
        out = np.empty((len(starts), len(self.a)), np.uint32)
        for k in range(len(self.a)):
            h = ((shingles * self.a[k] + self.b[k]) >> np.uint64(32)).astype(np.uint32)
            out[:, k] = np.minimum.reduceat(h, starts)
        return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per document and band; different bands have different keys."""
    out = np.empty((len(minima), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(minima), b + 1, np.uint64)
        for r in range(rows):
            key = mix(key + minima[:, b * rows + r].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        out[:, b] = key
    return out


def shingle_set(text: str | None, words_of: WordHash, k: int) -> np.ndarray:
    words = lower_space_words(text)
    return np.unique(shingle_hashes(words_of.array(words), k)) if words else np.zeros(0, np.uint64)


def text_key() -> Column:
    """128 bits of a text; equal for equal texts."""
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary")))


def _signatures(texts: Column, k: int, bands: int, rows: int) -> Column:
    @F.pandas_udf("n_shingles long, bands array<long>, signature binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words_of, minhash = WordHash(), MinHash(bands * rows)
        for batch in batches:
            count = np.zeros(len(batch), np.int64)
            keys: list[np.ndarray | None] = [None] * len(batch)
            signs: list[bytes | None] = [None] * len(batch)
            sets: list[np.ndarray] = []
            where: list[int] = []
            size = 0

            def flush() -> None:
                if sets:
                    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
                    minima = minhash.minima(np.concatenate(sets), starts)
                    got = signed(band_keys(minima, bands, rows))
                    for i, row, sign in zip(where, got, minima.astype("<u2"), strict=True):
                        keys[i], signs[i] = row, sign.tobytes()
                    sets.clear()
                    where.clear()

            for i, text in enumerate(batch):
                own = shingle_set(text, words_of, k)
                count[i] = len(own)
                if len(own):
                    sets.append(own)
                    where.append(i)
                    size += len(own)
                if size > 1 << 15:  # stays in the processor's cache
                    flush()
                    size = 0
            flush()
            yield pd.DataFrame({"n_shingles": count, "bands": keys, "signature": signs})
            relax()

    return run(texts)


def least_same(hashes: int, percent: int) -> float:
    """Equal minima that similar sets have at least, up to six standard deviations below what is expected."""
    p = percent / 100
    return hashes * p - 6 * (hashes * p * (1 - p)) ** 0.5


def links_of(sets: list[np.ndarray], signature: np.ndarray, cross: int | None, percent: int, joined: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Indexes of pairs of sets at ``percent`` similarity or more, just enough of them to join all that such pairs join.
    cross: if given, only pairs with one index below and one at or above it count. joined: sets that are one part already."""
    n = len(sets)
    label = np.arange(n)
    if joined is not None and joined.any():
        label[joined] = np.flatnonzero(joined)[0]
    size = np.array([len(s) for s in sets])
    out: list[tuple[int, int]] = []
    least = least_same(signature.shape[1], percent)
    first, second, alike = [], [], []
    for i in range(n if cross is None else cross):
        j0 = i + 1 if cross is None else cross
        if j0 >= n:
            continue
        near = (np.minimum(size[j0:], size[i]) * 100 >= np.maximum(size[j0:], size[i]) * percent) & (label[j0:] != label[i])
        same = np.zeros(n - j0, np.int64)
        k = np.flatnonzero(near)
        same[k] = (signature[j0 + k] == signature[i]).sum(axis=1)
        k = k[same[k] >= least]
        first.append(np.full(len(k), i))
        second.append(j0 + k)
        alike.append(same[k])
    if not first:
        return out
    a, b, score = np.concatenate(first), np.concatenate(second), np.concatenate(alike)
    order = np.argsort(-score, kind="stable")
    a, b = a[order], b[order]
    at = 0
    while at < len(a):
        some = slice(at, at + 2048)
        for i, j in zip(a[some].tolist(), b[some].tolist(), strict=True):
            if label[i] != label[j]:
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    label[label == label[j]] = label[i]
                    out.append((i, j))
        at += 2048
        left = label[a[at:]] != label[b[at:]]  # pairs inside a joined part need no look
        a, b = np.concatenate((a[:at], a[at:][left])), np.concatenate((b[:at], b[at:][left]))
    return out


def forest(signature: np.ndarray, size: np.ndarray, cross: int | None, percent: int) -> list[tuple[int, int]]:
    """Indexes of pairs whose signatures and sizes may be those of similar sets, just enough to join all that such pairs join."""
    n = len(size)
    label = np.arange(n)
    least = least_same(signature.shape[1], percent)
    out = []
    for i in range(n if cross is None else cross):
        j0 = i + 1 if cross is None else cross
        k = j0 + np.flatnonzero((np.minimum(size[j0:], size[i]) * 100 >= np.maximum(size[j0:], size[i]) * percent) & (label[j0:] != label[i]))
        k = k[(signature[k] == signature[i]).sum(axis=1) >= least]
        parts, at = np.unique(label[k], return_index=True)
        if len(parts):
            out += [(i, int(j)) for j in k[at]]
            label[np.isin(label, parts)] = label[i]
    return out


def _dealt(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys)


def _pairs(links: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(links, columns=["a", "b"]).astype("int64")


def fine_groups(members: DataFrame, percent: int, total: int) -> DataFrame:
    """node, fine: members (node, comp, n_shingles, signature) of coarse groups whose signatures agree with another's of the group, by the
    smallest node that such agreement reaches."""
    sizes = stored(members.groupBy("comp").agg(F.count("*").alias("n"), F.ceil(F.count("*") / SIGNATURES).cast("int").alias("blocks")))
    placed = keyed_join(members, sizes, "comp", "n", total).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi"))))
    rows = placed.select("comp", pair.alias("p"), "block", "node", "n_shingles", "signature").select("comp", "p.lo", "p.hi", "block", "node", "n_shingles", "signature")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple[int, int]] = []
        for group in stream_groups(batches, ["comp", "lo", "hi"]):
            if len(group) < 2:
                continue
            group = group.sort_values(["block", "node"], kind="stable")
            block, node = group["block"].to_numpy(), group["node"].to_numpy()
            cross = None if group["lo"].iloc[0] == group["hi"].iloc[0] else int((block == block.min()).sum())
            signature = np.frombuffer(b"".join(group["signature"]), "<u2").reshape(len(group), -1)
            out += [(int(node[i]), int(node[j])) for i, j in forest(signature, group["n_shingles"].to_numpy(), cross, percent)]
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return components(_dealt(rows, ["comp", "lo", "hi"]).mapInPandas(run, "a long, b long")).withColumnRenamed("component", "fine")


def _starred(texts: DataFrame, k: int, percent: int) -> DataFrame:
    """(fine, node, text_key, joined) from rows (fine, chunk, node, text_key, text): whether a text is similar to one of the group's smallest
    node, which is in every chunk."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for group in stream_groups(batches, ["fine", "chunk"]):
            middle = (group["node"] == group["fine"]).to_numpy()
            sets = [shingle_set(t, words_of, k) for t in group["text"]]
            centers = [s for s, m in zip(sets, middle, strict=True) if m]
            joined = []
            for own, m in zip(sets, middle, strict=True):
                found = bool(m)
                for c in () if m else centers:
                    both = len(np.intersect1d(own, c, assume_unique=True))
                    found = found or 100 * both >= percent * (len(own) + len(c) - both)
                joined.append(found)
            yield pd.DataFrame({"fine": group["fine"], "node": group["node"], "text_key": group["text_key"], "joined": joined})

    return _dealt(texts, ["fine", "chunk"]).mapInPandas(run, "fine long, node long, text_key binary, joined boolean")


def _verified(texts: DataFrame, k: int, percent: int, hashes: int) -> DataFrame:
    """Links (a, b) from rows (fine, lo, hi, block, joined, node, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words_of, minhash = WordHash(), MinHash(hashes)
        out: list[tuple[int, int]] = []
        for group in stream_groups(batches, ["fine", "lo", "hi"]):
            group = group.sort_values(["block", "node"], kind="stable").drop_duplicates(["node", "text"])  # an id with two texts has a set for each
            nodes = group["node"].tolist()
            sets = [shingle_set(t, words_of, k) for t in group["text"]]
            if len(sets) < 2:
                continue
            block = group["block"].to_numpy()
            cross = None if group["lo"].iloc[0] == group["hi"].iloc[0] else int((block == block.min()).sum())
            signature = minhash.minima(np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets[:-1]]))
            out += [(nodes[i], nodes[j]) for i, j in links_of(sets, signature, cross, percent, group["joined"].to_numpy(bool)) if nodes[i] != nodes[j]]
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return _dealt(texts, ["fine", "lo", "hi"]).mapInPandas(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, shingle: int = 5, percent: int = 80, bands: int = 32, rows: int = 4, block: int = 512, block_shingles: int = 2_000_000
) -> DataFrame:
    """Columns doc_id, text_key, n_shingles, component_id, kept: one row per row of docs (doc_id long, text).

    Documents with 100 * intersection >= percent * union of their word-shingle sets are linked; component_id is the
    smallest doc_id reachable, kept whether it is the row's own. A text of fewer words than a shingle is one
    shingle; one without words, or null, is linked with nothing, and so is a row without doc_id (component_id
    null, kept true). Rows that share doc_id and text are alike; an id with two texts is one node for each text,
    named by the smallest id of its copies. Other columns aren't read.
    """
    seen = stored(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
        .withColumn("s", _signatures(F.col("text"), shingle, bands, rows))
        .select("doc_id", "text_key", "s.n_shingles", "s.bands", "s.signature")
    )
    total = seen.count()
    nodes = stored(
        seen.filter("doc_id is not null and n_shingles > 0")
        .groupBy("text_key")
        .agg(F.min("doc_id").alias("node"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("signature").alias("signature"))
    )
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    centers = stored(buckets.groupBy("bucket").agg(F.min("node").alias("center"), F.count("*").alias("n")).filter("n > 1"))
    near = keyed_join(buckets, centers, "bucket", "n", total * bands)
    coarse = stored(components(near.select(F.col("node").alias("a"), F.col("center").alias("b"))).withColumnRenamed("component", "comp"))

    fine = fine_groups(coarse.join(nodes.select("node", "n_shingles", "signature"), "node"), percent, total)
    members = stored(fine.join(nodes.select("node", "text_key", "n_shingles"), "node"))
    own = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))

    def with_texts(placed: DataFrame) -> DataFrame:
        """placed (stored, as it is read more than once) with texts. Where ids are sent, only the texts of these ids are shuffled."""
        some = own.join(F.broadcast(placed.select("node")), "node", "left_semi") if placed.count() <= MOST_SENT else own
        return some.withColumn("text_key", text_key()).join(placed, ["node", "text_key"])

    parts = F.greatest(F.lit(1), F.ceil(F.count("*") / block), F.ceil(F.sum("n_shingles") / block_shingles)).cast("int")
    sizes = stored(members.groupBy("fine").agg(F.count("*").alias("n"), parts.alias("chunks")))
    chunk = F.when(F.col("node") == F.col("fine"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))
    chunked = stored(keyed_join(members, sizes, "fine", "n", total).select("fine", "node", "text_key", F.explode(chunk).alias("chunk")))
    starred = stored(_starred(with_texts(chunked), shingle, percent).distinct())
    # groups of two are settled; of others those with open texts go on
    told = members.join(starred, ["fine", "node", "text_key"])
    opened = stored(
        told.groupBy("fine").agg(
            F.count("*").alias("n"), F.count_if(~F.col("joined")).alias("n_open"),
            *[F.greatest(F.lit(1), F.ceil(F.count_if(w) / block), F.ceil(F.sum(F.when(w, F.col("n_shingles"))) / block_shingles)).cast("int").alias(name) for name, w in (("open_blocks", ~F.col("joined")), ("other_blocks", F.col("joined")))],
        ).filter("n > 2 and n_open > 0").drop("n_open")
    )
    at = F.when(F.col("joined"), F.col("open_blocks") + F.pmod(F.xxhash64("node"), F.col("other_blocks"))).otherwise(F.pmod(F.xxhash64("node"), F.col("open_blocks"))).cast("int")
    placed = keyed_join(told, opened, "fine", "n", total).withColumn("block", at)
    against = F.sequence(F.lit(0), F.when(F.col("joined"), F.col("open_blocks") - 1).otherwise(F.col("open_blocks") + F.col("other_blocks") - 1))
    pair = F.explode(F.transform(against, lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi"))))
    texts = with_texts(stored(placed.select("fine", "node", "text_key", "joined", "block", "open_blocks", "other_blocks"))).select("fine", pair.alias("p"), "block", "joined", "node", "text").select("fine", "p.lo", "p.hi", "block", "joined", "node", "text")
    links = _verified(texts, shingle, percent, bands * rows).unionByName(starred.filter("joined and node <> fine").select(F.col("node").alias("a"), F.col("fine").alias("b")))
    found = components(links)

    group = stored(
        nodes.select("text_key", "node", "n").join(found, "node", "left").select("text_key", "n", F.coalesce("component", "node").alias("component_id"))
    )
    linked = seen.filter("doc_id is not null and n_shingles > 0").select("doc_id", "text_key", "n_shingles")
    alone = seen.filter("doc_id is null or n_shingles = 0").select("doc_id", "text_key", "n_shingles", F.col("doc_id").alias("component_id"))
    return keyed_join(linked, group, "text_key", "n", total).select(*alone.columns).unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_one(docs: DataFrame, **options: int) -> DataFrame:
    """docs with one document of each group of near duplicates: that with the smallest doc_id. Repeated rows of it are
    dropped but for one. All columns stay; rows without doc_id or words stay."""
    found = stored(near_duplicates(docs, **options))
    gone = found.filter("not kept").select("doc_id", "text_key").distinct()
    again = found.filter("kept and doc_id is not null and n_shingles > 0").groupBy("doc_id", "text_key").count().filter("count > 1").select("doc_id", "text_key")
    key = "_text_key"
    while key in docs.columns:
        key = f"_{key}"
    rows = docs.withColumn(key, text_key())

    def off(table: DataFrame, how: str) -> DataFrame:
        named = table.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
        if named.count() <= MOST_SENT:
            named = F.broadcast(named)
        return rows.join(named, (rows["doc_id"] == named["_id"]) & (rows[key] == named["_key"]), how)

    names = docs.columns
    if again.isEmpty():
        return off(gone, "left_anti").select(*[F.col(f"`{c}`") for c in names])
    left = off(gone.union(again), "left_anti")
    once = off(again, "left_semi").dropDuplicates(["doc_id", key])
    return left.union(once).select(*[F.col(f"`{c}`") for c in names])
