"""Repeated passages by sparse suffix arrays.

A passage of ``length`` words holds ``length - anchor + 1`` runs of ``anchor`` words; the one with the least hash is its
minimiser. Wherever the passage stands, the same run is picked, so only suffixes that begin at minimisers are
kept (about 2 in 35 with the defaults). Suffixes whose first run of words occurs in one document only are
dropped before any text moves. The rest are sorted with their context: neighbours in the order have the longest
common prefixes, which bound groups whose passages agree to the right; inside a group, equal contexts to the
left complete the match. So every window of ``length`` words that occurs in two documents is found, and no other.

Groups are dealt by their first run of words. The few runs that occur over ``most`` times (a passage that a large
part of the corpus shares) would overfill a task: their windows are counted one by one instead, map-side first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHash, lower_space_words, shingle_hashes, shuffle_partitions, signed, stored
from .components import keyed_join
from .neardup import text_key

#: Tasks over which the rows of one frequent window are spread.
SALTS = 32


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least of each ``window`` neighbours, the leftmost of equal ones; sorted, without repeats."""
    n = len(grams)
    if n < window:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 28) - 1)
    x = (grams & ~low) | (np.arange(n, dtype=np.uint64) & low)
    size = 1
    while size * 2 <= window:
        x = np.minimum(x[: len(x) - size], x[size:])
        size *= 2
    if window > size:
        x = np.minimum(x[: len(x) - (window - size)], x[window - size :])
    at = (x & low).astype(np.int64)
    return np.unique(at) if n <= 1 << 28 else np.unique(at + (np.arange(len(at)) - at + (1 << 27) >> 28 << 28))


def _anchors(texts: Column, length: int, anchor: int) -> Column:
    @F.pandas_udf("n_words long, runs array<long>, places array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for batch in batches:
            rows = []
            for text in batch:
                words = lower_space_words(text)
                if len(words) < length:
                    rows.append((len(words), [], []))
                    continue
                grams = shingle_hashes(words_of.array(words), anchor)
                at = minimisers(grams, length - anchor + 1)
                rows.append((len(words), signed(grams[at]), at.astype(np.int32)))
            yield pd.DataFrame(rows, columns=["n_words", "runs", "places"])

    return run(texts)


def _contexts(texts: DataFrame, length: int, anchor: int, hot: bool) -> DataFrame:
    """Suffixes with context from rows (text_key, node, text, anchors); of hot anchors, their windows instead. The anchor's own
    words aren't part of the context: its run tells them."""
    side = length - anchor

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        words_of = WordHash()
        for batch in batches:
            for key, node, text, anchors in zip(batch["text_key"], batch["node"], batch["text"], batch["anchors"], strict=True):
                words = words_of.array(lower_space_words(text))
                grams = shingle_hashes(words, anchor)
                # an id with several texts has anchors of all of them: a text's own are those that are where they should be
                own = [(x["run"], x["place"]) for x in anchors if x["hot"] == hot and x["place"] < len(grams) and signed(grams[x["place"] : x["place"] + 1])[0] == x["run"]]
                if own:
                    yield key, node, words, own

    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["run", "right", "left", "node", "text_key", "place"]
        rows: list[tuple] = []
        for key, node, words, anchors in placed(batches):
            cells = (words >> np.uint64(32)).astype(">u4")
            back = cells[::-1]
            n = len(cells)
            for run, p in anchors:
                rows.append((run, cells[p + anchor : p + length].tobytes(), back[n - p : n - p + side].tobytes(), node, key, p))
            if len(rows) > 10_000:
                yield pd.DataFrame(rows, columns=names)
                rows = []
        yield pd.DataFrame(rows, columns=names).astype({"run": "int64", "node": "int64", "place": "int32"})

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for key, node, words, anchors in placed(batches):
            whole = shingle_hashes(words, length)
            at = np.unique((np.array([p for _, p in anchors])[:, None] - np.arange(side + 1)).ravel())
            at = at[(at >= 0) & (at < len(whole))]
            yield pd.DataFrame({"window": signed(whole[at]), "node": node, "text_key": [key] * len(at), "place": at.astype(np.int32)})

    if hot:
        return texts.mapInPandas(windows, "window long, node long, text_key binary, place int")
    return texts.mapInPandas(suffixes, "run long, right binary, left binary, node long, text_key binary, place int")


def _whole_runs(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Batches cut and joined so that rows with equal keys, which come together, are in one."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = batch[key].to_numpy()
        if rest and rest[-1][key].iloc[-1] != values[0]:
            yield pd.concat(rest, ignore_index=True)
            rest = []
        cut = int(np.searchsorted(values, values[-1], side="left"))
        if cut:
            yield pd.concat([*rest, batch.iloc[:cut]], ignore_index=True)
            rest = []
        rest.append(batch.iloc[cut:])
    if rest:
        yield pd.concat(rest, ignore_index=True)


def _matrix(values: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
    size = values.str.len().to_numpy() // 4
    data = b"".join(v.ljust(width * 4, b"\0") for v in values)
    return np.frombuffer(data, ">u4").astype(np.uint32).reshape(len(values), width), size


def matched(group: pd.DataFrame, length: int, anchor: int) -> pd.DataFrame:
    """Matched stretches (text_key, node, start, stop) of suffixes that come in the order of (run, right context)."""
    side = length - anchor
    run, node = group["run"].to_numpy(), group["node"].to_numpy()
    right, right_size = _matrix(group["right"], side)
    left, left_size = _matrix(group["left"], side)
    n = len(group)
    # longest common prefix, beyond the anchor, with the suffix before
    same = right[1:] == right[:-1]
    lcp = np.where(same.all(axis=1), side, np.argmin(same, axis=1)) if side else np.zeros(n - 1, np.int64)
    lcp = np.minimum(lcp, np.minimum(right_size[1:], right_size[:-1]))
    lcp[run[1:] != run[:-1]] = -1
    far = np.full(n, -1)
    near = np.full(n, -1)
    context = np.zeros(n, np.uint64)
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    for back in range(side + 1):
        if back:
            context = (context ^ left[:, back - 1]) * multiplier
            context ^= context >> np.uint64(29)
        part = np.concatenate(([0], np.cumsum(lcp < side - back)))
        ok = np.flatnonzero((left_size >= back) & (right_size >= side - back))
        if len(ok) < 2:
            continue
        order = ok[np.lexsort((context[ok], part[ok]))]
        fresh = np.concatenate(([True], (part[order][1:] != part[order][:-1]) | (context[order][1:] != context[order][:-1])))
        starts = np.flatnonzero(fresh)
        some = node[order]
        across = np.minimum.reduceat(some, starts) != np.maximum.reduceat(some, starts)
        hit = order[across[np.cumsum(fresh) - 1]]
        far[hit] = back
        near[hit] = np.where(near[hit] < 0, back, near[hit])
    hit = np.flatnonzero(far >= 0)
    place = group["place"].to_numpy()[hit]
    return pd.DataFrame({
        "text_key": group["text_key"].to_numpy()[hit], "node": node[hit],
        "start": (place - far[hit]).astype(np.int32), "stop": (place - near[hit] + length).astype(np.int32),
    })


def merge_spans(spans: DataFrame) -> DataFrame:
    """Touching or overlapping spans (text_key, node, start, stop) of a text joined."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["text_key", "node", "start", "stop"]
        last: list | None = None
        for batch in batches:
            out = []
            for key, node, start, stop in zip(*(batch[c].tolist() for c in names), strict=True):
                if last and last[0] == key and last[1] == node and start <= last[3]:
                    last[3] = max(last[3], stop)
                else:
                    if last:
                        out.append(tuple(last))
                    last = [key, node, start, stop]
            yield pd.DataFrame(out, columns=names).astype({"node": "int64", "start": "int32", "stop": "int32"})
        if last:
            yield pd.DataFrame([tuple(last)], columns=names).astype({"node": "int64", "start": "int32", "stop": "int32"})

    dealt = spans.repartition(shuffle_partitions(spans.sparkSession), "text_key", "node").sortWithinPartitions("text_key", "node", "start")
    return dealt.mapInPandas(run, "text_key binary, node long, start int, stop int")


def expand(spans: DataFrame, nodes: DataFrame, docs: DataFrame, length: int, total: int) -> DataFrame:
    """Spans of one text each to all documents with the text; a text of several documents is a span as a whole.
    nodes: text_key, n (rows), node and last (least and greatest doc_id), n_words."""
    whole = nodes.filter("node < last").filter(F.col("n_words") >= length)
    parts = spans.join(whole.select("text_key"), "text_key", "left_anti").join(nodes.select("text_key", "n"), "text_key").select("text_key", "n", "start", "stop")
    every = parts.unionByName(whole.select("text_key", "n", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("stop")))
    listed = stored(every.groupBy("text_key").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans")))
    rows = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key")).distinct()
    found = keyed_join(rows, listed, "text_key", "n", total)
    return found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.start", "s.stop", (F.col("s.stop") - F.col("s.start")).cast("long").alias("n_words"))


def repeated_passages(docs: DataFrame, *, length: int = 50, anchor: int = 17, most: int = 20_000) -> DataFrame:
    """Columns doc_id, start, stop (word places, stop excluded), n_words: the stretches of each document all of whose words
    lie in a window of ``length`` words that another document has too. Documents without any have no row.

    Words stand between ASCII white space; A-Z count as a-z. Null and empty texts, and rows without doc_id,
    have no part in it. Rows with equal doc_id are one document. Repeats inside one document don't count.
    """
    spark = docs.sparkSession
    seen = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    nodes = stored(
        seen.withColumn("a", _anchors(F.col("text"), length, anchor))
        .select("doc_id", "text_key", "a.*")
        .groupBy("text_key")
        .agg(F.min("doc_id").alias("node"), F.max("doc_id").alias("last"), F.count("*").alias("n"), F.first("n_words").alias("n_words"), F.first("runs").alias("runs"), F.first("places").alias("places"))
    )
    total = nodes.agg(F.sum("n"), F.sum(F.size("runs"))).first()
    anchors = nodes.select("node", F.explode(F.arrays_zip(F.col("runs").alias("run"), F.col("places").alias("place"))).alias("x")).select("node", "x.run", "x.place")
    runs = stored(anchors.groupBy("run").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("run", "n", (F.col("n") > most).alias("hot")))
    shared = keyed_join(anchors, runs, "run", "n", total[1] or 0)
    wanted = shared.groupBy("node").agg(F.collect_list(F.struct("run", "place", "hot")).alias("anchors"))
    texts = seen.select("text_key", F.col("doc_id").alias("node"), "text").join(wanted, "node")
    parts = shuffle_partitions(spark)
    dealt = _contexts(texts, length, anchor, False).repartition(parts, "run").sortWithinPartitions("run", "right")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_runs(batches, "run"):
            yield matched(group, length, anchor)

    spans = dealt.mapInPandas(match, "text_key binary, node long, start int, stop int")
    if not runs.filter("hot").isEmpty():
        # in the same query, so that the texts are shuffled once for both; a frequent window is spread by a salt
        windows = _contexts(texts, length, anchor, True)
        counts = windows.groupBy("window").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("window", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        again = windows.withColumn("salt", F.pmod(F.xxhash64("node", "place"), F.lit(SALTS)).cast("int")).join(counts, ["window", "salt"])
        spans = spans.unionByName(again.select("text_key", "node", F.col("place").alias("start"), (F.col("place") + length).alias("stop")))
    return expand(merge_spans(spans), nodes.select("text_key", "node", "last", "n", "n_words"), docs, length, total[0] or 0)
