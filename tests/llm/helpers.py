"""Plain versions of what the operators find, and a table of awkward rows."""

from __future__ import annotations

import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, out string, node long, stats string"


def awkward(spark, more=()):
    """Null ids, texts and strata, empty and white texts, ties, repeated rows, a very long text, clashing names."""
    words = " ".join(f"w{i % 977}x{i % 61}" for i in range(60_000))
    passage = " ".join(f"p{i}" for i in range(80))
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, "one", "en"), (5, "Two words", "fr"), (6, words, "en"), (7, words, "en"),
        (7, words, "en"), (None, "no id at all " * 20, "en"), (None, None, None), (8, f"left a b {passage} right", "en"),
        (9, f"other start {passage}", "de"), (10, passage.upper(), "de"), (11, "one", "en"), (12, "ONE", "en"), (13, "é ü 中文 \U0001f600", "zz"),
    ]
    full = [(i, t, lang, "s", len(t or ""), "x", 5, "y") for i, t, lang in rows] + [(i, t, "en", "s", 0, "x", 5, "y") for i, t in more]
    return spark.createDataFrame(full, SCHEMA)


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = space_words(lower(text))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def linked(docs, k, percent):
    """Component of each id."""
    sets = {i: shingles(t, k) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    both = defaultdict(int)
    for ids in where.values():
        for x in range(len(ids)):
            for y in range(x):
                both[ids[y], ids[x]] += 1
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    return {i: top(i) for i in sets}, sets


def repeated(docs, length):
    """Stretches of words in windows that another id has too."""
    words = {}
    where = defaultdict(set)
    for i, t in docs:
        words[i] = space_words(lower(t))
        for p in range(len(words[i]) - length + 1):
            where[tuple(words[i][p : p + length])].add(i)
    out = set()
    for i, w in words.items():
        spans = []
        for p in range(len(w) - length + 1):
            if len(where[tuple(w[p : p + length])]) > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + length
                else:
                    spans.append([p, p + length])
        out |= {(i, s, e) for s, e in spans}
    return out
