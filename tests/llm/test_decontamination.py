from __future__ import annotations

import random
import re

from skyledger.llm import decontamination as dc
from tests.llm.support import LOWER, ODD_ROWS, documents

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text, items):
    words = WORD.findall((text or "").translate(LOWER))
    hit, named = set(), set()
    for item, body in items:
        own = WORD.findall((body or "").translate(LOWER))
        width = min(10, len(own))
        windows = {tuple(own[k : k + width]) for k in range(len(own) - width + 1)} if own else set()
        for k in range(len(words) - width + 1):
            if tuple(words[k : k + width]) in windows:
                hit.update(range(k, k + width))
                named.add(str(item))
    return len(words), len(hit), sorted(named)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def cases(seed=1):
    pick = random.Random(seed)
    vocabulary = ["a", "b", "c", "É", "d9", "ümlaut"]
    items = [(k, " ".join(pick.choices(vocabulary, k=pick.choice([1, 4, 10, 13, 25])))) for k in range(5, 25)]
    items += [(40, None), (41, "  ...  "), (42, "short item"), (43, items[0][1]), (5, items[0][1])]
    rows = []
    for k in range(60):
        body = pick.choices(vocabulary, k=pick.randint(0, 40))
        if pick.random() < 0.6:
            body += re.split(" ", pick.choice(items)[1] or "") + pick.choices(vocabulary, k=3)
        rows.append((k, pick.choice([" ", ", ", "\n--"]).join(w.upper() if pick.random() < 0.3 and w.isascii() else w for w in body), "en", "s", 0))
    return rows, items


def found(table, bench):
    return {r.doc_id: (r._n_words, r._n_hit, r._items) for r in dc.find_contamination(table, bench, ["doc_id"]).collect()}


def test_equals_a_search_window_by_window(spark):
    rows, items = cases()
    assert found(documents(spark, rows), benchmark(spark, items)) == {i: plain(t, items) for i, t, *_ in rows}


def test_a_large_benchmark_stays_in_spark(spark, monkeypatch):
    """Parts by item meet blocks of documents; the one place that fetches items is not reached."""
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", 600)
    monkeypatch.setattr(dc, "BLOCK_BYTES", 500)
    monkeypatch.setattr(dc, "_scan_at_once", None)
    rows, items = cases(2)
    rows += [(100, None, "en", "s", 0), (101, "", "en", "s", 0), (102, rows[0][1] + " " + rows[1][1], "en", "s", 0)]
    assert found(documents(spark, rows), benchmark(spark, items)) == {i: plain(t, items) for i, t, *_ in rows}


def test_spans_of_both_ways_are_the_same(spark, monkeypatch):
    rows, items = cases(3)
    table, bench = documents(spark, rows), benchmark(spark, items)
    at_once = sorted(map(tuple, dc.find_contamination(table, bench, ["doc_id", "source"]).collect()))
    monkeypatch.setattr(dc, "AUTOMATON_BYTES", 600)
    assert sorted(map(tuple, dc.find_contamination(table, bench, ["doc_id", "source"]).collect())) == at_once


def test_the_empty_text_is_an_id(spark):
    bench = spark.createDataFrame([("", "alpha beta"), (None, "gamma delta")], "item_id string, text string")
    rows = dc.find_contamination(documents(spark, [(1, "alpha beta gamma delta", "en", "s", 0)]), bench, ["doc_id"]).collect()
    assert (rows[0]._n_hit, rows[0]._items) == (4, [""])


def test_clashing_columns(spark, monkeypatch):
    names = ["_row", "_text", "_keep", "row", "part", "_runs", "_n_words"]
    table = documents(spark, [(1, "token here", "en", "s", 0)], **dict.fromkeys(names, "clash"))
    for size in (dc.AUTOMATON_BYTES, 1):
        monkeypatch.setattr(dc, "AUTOMATON_BYTES", size)
        row = dc.find_contamination(table, benchmark(spark, [(2, "token"), (3, "here")]), ["doc_id", *names]).first()
        assert (row._row, row._keep, row._runs, row._n_words, row._items) == ("clash", "clash", "clash", 2, ["2", "3"])


def test_spans_lead_back_to_the_text(spark):
    text = "Before: ALPHA, beta;\ngamma — delta! After."
    rows = dc.find_contamination(documents(spark, [(1, text, "en", "s", 0)]), benchmark(spark, [(1, "alpha beta gamma")]), ["doc_id"]).collect()
    assert [text[s.start : s.end] for s in rows[0]._spans] == ["ALPHA, beta;\ngamma"]
    assert rows[0]._contaminated


def test_odd_rows(spark):
    items = [(1, "the same row twice"), (None, "without an id"), (2, "token")]
    table = documents(spark, ODD_ROWS, _n_words="clash", item_id=3)
    rows = dc.find_contamination(table, benchmark(spark, items), ["doc_id"]).collect()
    answer = {r.doc_id: (r._n_words, r._n_hit, r._items) for r in rows}
    assert len(rows) == len(ODD_ROWS)
    assert answer[905] == (8, 8, ["1"]) and answer[908][2] == ["2"] and answer[901] == (0, 0, [])
    assert answer[None][1:] == (3, [])
    assert dc.find_contamination(documents(spark, []), benchmark(spark, items), ["doc_id"]).collect() == []
    clean = dc.find_contamination(table, benchmark(spark, []), ["doc_id"]).collect()
    assert len(clean) == len(ODD_ROWS) and not any(r._contaminated for r in clean)
