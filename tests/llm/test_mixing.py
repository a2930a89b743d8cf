from __future__ import annotations

import random
from collections import defaultdict

import pytest

from skyledger.llm import mixing
from tests.llm.support import ODD_ROWS, documents, words


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Share everything by weight; sources above their cap keep it, the rest is shared again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, rest, active = {}, sum(sizes.values()), set(order)
    while active:
        total = sum(weight[s] for s in active)
        over = {s for s in active if rest * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: rest * weight[s] / total for s in active}
        target |= {s: most * sizes[s] for s in over}
        rest -= sum(most * sizes[s] for s in over)
        active -= over
    return target


def mixed(spark, rows, **extra):
    table = documents(spark, rows, **extra)
    return mixing.with_copies(table, mixing.mixing_plan(table)).collect()


def rows_of(seed, sources=5, n=400):
    pick = random.Random(seed)
    names = [None, "", *[f"s{k}" for k in range(sources)]]
    share = [pick.random() ** 2 for _ in names]
    return [(i, "w " * int(pick.expovariate(1 / 40)), "en", pick.choices(names, share)[0], 0) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_targets_and_taken_words(spark, seed):
    rows = rows_of(seed)
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    expected = plain_targets(sizes)
    taken = defaultdict(int)
    largest = defaultdict(int)
    for r in mixed(spark, rows):
        assert r._size == len(words(r.text)) and r._source_size == sizes[r.source]
        assert r._target == pytest.approx(expected[r.source])
        assert 0 <= r._copies <= 3
        taken[r.source] += r._copies * r._size
        largest[r.source] = max(largest[r.source], r._size)
    for source, target in expected.items():
        assert abs(taken[source] - target) <= largest[source] / 2 + 1


def test_reruns_agree_and_partitions_do_not_matter(spark):
    rows = rows_of(7)
    once = {r.doc_id: r._copies for r in mixed(spark, rows)}
    table = documents(spark, rows[::-1]).repartition(7)
    again = {r.doc_id: r._copies for r in mixing.with_copies(table, mixing.mixing_plan(table)).collect()}
    assert once == again


def test_rates_are_exponential_tilts_that_meet_the_targets(spark):
    table = documents(spark, rows_of(9))
    for r in mixing.mixing_plan(table).filter("multiplier IS NOT NULL").collect():
        own = [len(words(d[1])) for d in rows_of(9) if d[3] == r.source]
        import math

        expected = sum(s * min(3, math.exp(min(5, r.multiplier * s / r.mean_size))) for s in own if s)
        assert expected == pytest.approx(r.target, rel=1e-4)


def test_mix_repeats_rows(spark):
    table = documents(spark, rows_of(11))
    copies = {r.doc_id: r._copies for r in mixing.with_copies(table, mixing.mixing_plan(table)).collect()}
    assert mixing.mix(table).count() == sum(copies.values())
    assert mixing.mix(table).columns == table.columns


def test_odd_rows(spark):
    rows = mixed(spark, ODD_ROWS, _size="clash", target=1, multiplier=None, low="x")
    assert len(rows) == len(ODD_ROWS) and rows[0].target == 1
    assert all(r._copies == 0 for r in rows if not words(r.text))
    twice = {r._copies for r in rows if r.doc_id == 905}
    assert len(twice) == 1
    assert mixed(spark, []) == []
    assert [r._copies for r in mixed(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])] == [0, 0]


@pytest.mark.parametrize("hot_id", [None, 7])
def test_a_third_of_all_rows_alike(spark, hot_id):
    """Rows that share id, text and source need not flip together: targets are met, in any order of rows."""
    text = "one two three four five"
    rows = [(hot_id if i % 3 == 0 else i, text, "en", "ab"[i % 2], 23) for i in range(3000)]
    rows += [(10_000 + i, "w " * (1 + i % 40), "en", "c", 0) for i in range(600)]
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    table, turned = documents(spark, rows), documents(spark, rows[::-1]).repartition(9)
    results = mixing.mixed(table), mixing.with_copies(turned, mixing.mixing_plan(turned))
    found = [sorted((r.doc_id or 0, r.source, r._size, r._copies) for r in result.collect()) for result in results]
    assert all(f == found[0] for f in found) and len(found[0]) == len(rows)
    taken = defaultdict(int)
    for _, source, size, copies in found[0]:
        assert 0 <= copies <= 3
        taken[source] += size * copies
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 20 + 1


def test_columns_of_any_name(spark):
    names = ["_size", "_copies", "uniform", "often", "place", "block", "alike", "_keep", "_plan_source", "size", "n", "number", "before"]
    table = documents(spark, [*ODD_ROWS, (901, "two words", "en", "s1", 0)], **{n: "clash" for n in names})
    rows = mixing.mixed(table).collect()
    assert len(rows) == len(ODD_ROWS) + 1
    assert all(r[n] == "clash" for r in rows for n in names[2:])
    assert {r._size for r in rows if r.text == "two words"} == {2}
