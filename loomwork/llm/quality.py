"""Quality rules whose cutoffs are certified on labelled holdouts.

A fixed base rule rejects texts under 50 words or with over half of their words in repeated 3-word windows. Each
further rule rejects a text when one ratio exceeds a cutoff. Cutoffs are picked per stratum (language) from
labelled rows: going from the most lenient cutoff to the strictest, a cutoff is certified while the exact
binomial test refutes a false-rejection rate above the rule's share of ``risk``. The sequence
stops at the first failure, which needs no correction inside it; over strata and rules the level is divided by
their number (Bonferroni). So with probability 1 - ``level`` no stratum loses over ``risk`` of its good texts to the
rules. Of the certified cutoffs the one that separates the labels best is taken; without one the rule is off.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHash, free, relax, shingle_hashes, stored, utf8

STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long"
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_UPPER = bytes(range(0x41, 0x5B))
_FOLLOW = bytes(range(0x80, 0xC0))  # UTF-8 bytes that don't begin a character

#: Ratios of the rules, by name: numerator, denominator. All lie between 0 and the cap of the grid, or are cut to it.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeats": ("n_repeat_words", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "upper": ("n_upper", "word_chars"),
}
#: Parts of the risk that the rules may spend. The rule that tells most gets most, so that small strata can certify it.
SHARES = {"symbols": 0.6, "repeats": 0.2, "dup_lines": 0.1, "upper": 0.1}
#: Cutoffs that are tried, from lenient to strict: 1.00, 0.98, ... 0.02.
STEPS = 50


#: Words beyond which repeated windows are found over hashes.
LONG = 50_000


def stats(text: str | None, words_of: WordHash) -> tuple[int, ...]:
    """Counts of one text; null has none of anything."""
    data = utf8(text)
    words = data.split()
    n = len(words)
    chars = len(data.translate(None, _SPACE + _FOLLOW))
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = 0
    if 4 <= n <= LONG:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):  # most texts end here
            count = Counter(windows)
            hit = bytearray(n)
            for k, w in enumerate(windows):
                if count[w] > 1:
                    hit[k : k + 3] = b"\1\1\1"
            repeats = sum(hit)
    elif n > LONG:  # the same over hashes, whose memory is a tenth
        windows = shingle_hashes(words_of.array(words), 3)
        _, index, count = np.unique(windows, return_inverse=True, return_counts=True)
        again = count[index] > 1
        hit = np.zeros(n, bool)
        for k in range(3):
            hit[k : n - 2 + k] |= again
        repeats = int(hit.sum())
    return (
        n, chars, len(data) - len(data.translate(None, _SYMBOLS)), len(lines) - len(set(lines)), repeats, len(lines),
        len(data) - len(data.translate(None, _UPPER)),
    )


def text_stats(text: Column) -> Column:
    """The counts as a struct column."""
    names = [x.split()[0] for x in STATS.split(", ")]

    @F.pandas_udf(STATS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words_of = WordHash()
        for batch in batches:
            yield pd.DataFrame([stats(t, words_of) for t in batch], columns=names, dtype=np.int64)
            relax()

    return run.asNondeterministic()(text.cast("string"))  # so that it runs once, below no join and not again for a filter


def base_failed(s: str) -> Column:
    return (F.col(f"{s}.n_words") < 50) | (100 * F.col(f"{s}.n_repeat_words") > 50 * F.col(f"{s}.n_words"))


def _ratio(s: str, rule: str) -> Column:
    a, b = RULES[rule]
    return F.coalesce(F.try_divide(F.col(f"{s}.{a}"), F.col(f"{s}.{b}")), F.lit(0.0))


def refuted(k: int, n: int, risk: float, level: float) -> bool:
    """Whether k false rejections among n refute, at this level, that the rate exceeds risk: P(Bin(n, risk) <= k) <= level."""
    if n <= 0 or k >= n * risk:
        return False
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk) for i in range(k + 1)]
    top = max(log)
    return top + math.log(math.fsum(math.exp(x - top) for x in log)) <= math.log(level)


def pick(good: list[int], bad: list[int], risk: float, level: float) -> float | None:
    """Cutoff from histograms over bins [i/STEPS, (i+1)/STEPS) of the labelled rows' ratios; the last bin is open.
    A cutoff c rejects ratios above c; the bin that begins at c counts as rejected too, so nothing is missed."""
    n_good, n_bad = sum(good), sum(bad)
    best, cutoff = 0.0, None
    lost = caught = 0
    for i in range(STEPS, 0, -1):
        lost += good[i]
        caught += bad[i]
        if not refuted(lost, n_good, risk, level):
            break
        gain = caught / max(1, n_bad) - lost / max(1, n_good)
        if gain > best + 1e-12:
            best, cutoff = gain, i / STEPS
    return cutoff


def calibrate(docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", risk: float = 0.05, level: float = 0.05) -> DataFrame:
    """Cutoffs by stratum: columns stratum and one per rule (null: the rule is off there).

    docs: doc_id, text, stratum column. labels: doc_id, quality (1 good, 0 bad); several labels of a document count
    as good if one is. All labelled documents that pass the base rule are counted; null ids match nothing, a null
    stratum is a stratum. Texts are counted where they lie: ids with their bins are shuffled to the labels, and histograms, of a few
    hundred numbers a stratum.
    """
    told = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("good"))
    own = docs.filter("doc_id is not null").select("doc_id", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), text_stats(F.col("text")).alias("s"))
    binned = F.array(*[F.least(F.lit(STEPS), F.floor(_ratio("s", r) * STEPS)).cast("byte") for r in RULES])
    rows = own.filter(~base_failed("s")).select("doc_id", "stratum", binned.alias("bins")).join(told, "doc_id")
    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col("bins")[k].cast("int").alias("bin")) for k, r in enumerate(RULES)]))
    counts = rows.select("stratum", "good", bins.alias("x")).groupBy("stratum", "x.rule", "x.bin").agg(
        F.sum(F.when(F.col("good") > 0, 1).otherwise(0)).alias("good"), F.sum(F.when(F.col("good") > 0, 0).otherwise(1)).alias("bad")
    )
    strata = docs.select(F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum")).agg(F.count_distinct("stratum").alias("n_strata"))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        per = level / (int(pdf["n_strata"].iloc[0]) * len(RULES))
        out: dict[str, object] = {"stratum": pdf["stratum"].iloc[0]}
        for r in RULES:
            own = pdf[pdf["rule"] == r]
            good, bad = [0] * (STEPS + 1), [0] * (STEPS + 1)
            for b, g, x in zip(own["bin"], own["good"], own["bad"], strict=True):
                good[b] += int(g)
                bad[b] += int(x)
            out[r] = pick(good, bad, risk * SHARES[r], per)
        return pd.DataFrame([out]).astype({r: "float64" for r in RULES})

    return counts.crossJoin(F.broadcast(strata)).groupBy("stratum").applyInPandas(choose, "stratum string, " + ", ".join(f"{r} double" for r in RULES))


#: Strata whose cutoffs are sent to every task; beyond, they are joined like any table.
MOST_STRATA = 10_000


def judge(docs: DataFrame, cutoffs: DataFrame, *, stratum: str = "lang", out: str = "quality") -> DataFrame:
    """docs with a column ``out``: struct of the counts, base_failed and kept. Null and empty texts fail the base rule;
    a stratum without cutoffs has just that rule. All rows and columns stay."""
    cutoffs = stored(cutoffs)
    s, key = free("stats", docs.columns), free("stratum", docs.columns)
    c = free("cutoffs", [*docs.columns, s, key])
    table = cutoffs.select(F.col("stratum").alias(key), F.struct(*RULES).alias(c))
    if cutoffs.count() <= MOST_STRATA:
        table = F.broadcast(table)
    seen = docs.withColumn(s, text_stats(F.col("text"))).withColumn(key, F.coalesce(F.col(stratum).cast("string"), F.lit("")))
    above = reduce(lambda a, b: a | b, [F.coalesce(_ratio(s, r) > F.col(f"{c}.{r}"), F.lit(False)) for r in RULES])
    verdict = F.struct(f"{s}.*", base_failed(s).alias("base_failed"), (~base_failed(s) & ~above).alias("kept"))
    return seen.join(table, key, "left").withColumn(free(out, docs.columns), verdict).drop(s, key, c)


def keep_good(docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", risk: float = 0.05, level: float = 0.05) -> DataFrame:
    """The documents that pass; their columns."""
    out = free("quality", docs.columns)
    cutoffs = calibrate(docs, labels, stratum=stratum, risk=risk, level=level)
    return judge(docs, cutoffs, stratum=stratum, out=out).filter(F.col(f"{out}.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
