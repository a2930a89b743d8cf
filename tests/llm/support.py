"""Tables made by hand and slow, plain answers to compare with."""

from __future__ import annotations

import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}

# Rows that every operator must take: NULL in each column, no text, repeated rows, a very long text.
ODD_ROWS = [
    (None, "a text without an id that has some words in it", "en", "s1", 40),
    (901, None, "en", "s1", 0),
    (902, "", "en", "s1", 0),
    (903, " \t\n", None, None, None),
    (904, "a text without a language or a source here", None, None, None),
    (905, "the same row twice the same row twice", "en", "s2", 37),
    (905, "the same row twice the same row twice", "en", "s2", 37),
    (906, "word " * 200_000, "en", "s1", 1_000_000),
    (907, "x" * 300_000, "de", "s1", 300_000),
    (908, "\u00c4\u00d6 \u00df\u00fc \U0001f600 \u212a \u017f token", "de", "", 14),
]


def documents(spark, rows, **extra):
    """A documents table; ``extra`` columns hold the same value in every row."""
    from pyspark.sql import functions as F

    table = spark.createDataFrame(rows, DOCUMENTS)
    return table.withColumns({name: F.lit(value) for name, value in extra.items()})


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    found = words((text or "").translate(LOWER))
    return frozenset(tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))) if found else frozenset()


def linked_components(rows):
    """doc_id -> (size of its set, smallest id reachable), comparing every pair."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}
