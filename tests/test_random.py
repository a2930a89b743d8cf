"""The three reports on random rows with NULLs, blanks, ties and quarter minutes, against plain Python."""

from __future__ import annotations

import random

import pytest

from skyledger import operators as ops
from tests import test_airlines, test_anomalies, test_delays
from tests.support import FLIGHT_ROW, dicts, flight_table


def random_flights(seed, airports, airlines):
    draw = random.Random(seed)

    def minutes(low, high, unknown=0.2):
        return None if draw.random() < unknown else draw.randint(4 * low, 4 * high) / 4

    changes = []
    for _ in range(600):
        cancelled = int(draw.random() < 0.25)
        delay = None if cancelled and draw.random() < 0.8 else minutes(-60, 120, 0.1)
        changes.append(
            {
                "ORIGIN": draw.choice(airports),
                "OP_UNIQUE_CARRIER": draw.choice(airlines),
                "MONTH": draw.choice([None, 1, 2, 3, 12]),
                "DEP_DELAY": delay,
                "ARR_DELAY": None if delay is None else delay + draw.randint(-8, 8) / 4,
                "CANCELLED": cancelled,
                "CANCELLATION_CODE": draw.choice(["A", "B", "C", "D", "E", "N/A"]),
                **{c: minutes(-1, 3) for c in FLIGHT_ROW if c.endswith("_DELAY") and c not in ("DEP_DELAY", "ARR_DELAY")},
            }
        )
    # One airline whose flights are all cancelled.
    changes += [{"ORIGIN": airports[0], "OP_UNIQUE_CARRIER": "ZZ", "DEP_DELAY": None, "ARR_DELAY": None, "CANCELLED": 1}] * 3
    return changes


@pytest.mark.parametrize("seed", range(3))
def test_airline_stats(spark, seed):
    table = flight_table(spark, *random_flights(seed, ["P", "Q", " "], ["A", "B", "C", ""]))
    assert dicts(ops.airline_stats(table)) == test_airlines.brute_force(dicts(table))


@pytest.mark.parametrize("seed", range(3))
def test_delay_report(spark, seed):
    table = flight_table(spark, *random_flights(seed, ["P", "Q", "R"], ["A", None]))
    assert dicts(ops.delay_report(table)) == test_delays.brute_force(dicts(table))


@pytest.mark.parametrize("seed", range(3))
def test_delay_report_is_its_join_form_with_unknown_airports(spark, seed):
    table = flight_table(spark, *random_flights(seed, ["P", "Q", None], ["A", None]))
    found = dicts(ops.delay_report(table))
    assert found == dicts(ops.join_causes(ops.delay_band_stats(table), ops.cause_totals(table)))
    assert {r["top3_causes"] for r in found if r["airport"] is None} == {"[]"}


@pytest.mark.parametrize("seed", range(3))
def test_anomaly_ranking(spark, seed):
    table = flight_table(spark, *random_flights(seed, ["P", "Q", None, "", "  "], ["A", "B", "C", "D", None, "", " "]))
    assert dicts(ops.anomaly_ranking(table)) == test_anomalies.brute_force(dicts(table))
    joined = ops.join_baseline(ops.pair_stats(table), ops.airport_baseline(table))
    assert dicts(ops.anomaly_ranking(table)) == dicts(joined)
