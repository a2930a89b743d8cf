from skyledger.operators.airlines import airline_stats, airline_stats_text
from skyledger.operators.anomalies import (
    airport_baseline,
    anomaly_ranking,
    join_baseline,
    label_distribution,
    pair_stats,
    rank_in_airport,
    worst_pairs,
)
from skyledger.operators.cleaning import clean_flights, cleaning_report
from skyledger.operators.delays import cause_totals, delay_band_stats, delay_report, join_causes, top_cause_rows
from skyledger.operators.partials import airline_stats_from, anomaly_ranking_from, delay_report_from, flight_partials
from skyledger.operators.subsets import hashed_subset, make_subset, numbered_subset
from skyledger.operators.timings import consolidate_timings, speedup, timing_pivot, timing_totals

__all__ = [
    "airline_stats",
    "airline_stats_from",
    "airline_stats_text",
    "airport_baseline",
    "anomaly_ranking",
    "anomaly_ranking_from",
    "cause_totals",
    "clean_flights",
    "cleaning_report",
    "consolidate_timings",
    "delay_band_stats",
    "delay_report",
    "delay_report_from",
    "flight_partials",
    "hashed_subset",
    "join_baseline",
    "join_causes",
    "label_distribution",
    "make_subset",
    "numbered_subset",
    "pair_stats",
    "rank_in_airport",
    "speedup",
    "timing_pivot",
    "timing_totals",
    "top_cause_rows",
    "worst_pairs",
]
