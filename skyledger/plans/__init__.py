from skyledger.plans.jobs import (
    REPORTS,
    run_cleaning,
    run_cleaning_month,
    run_partials,
    run_quarantine,
    run_report,
    run_report_merged,
    run_report_table,
    run_subsets,
    run_timings,
)

__all__ = [
    "REPORTS",
    "run_cleaning",
    "run_cleaning_month",
    "run_partials",
    "run_quarantine",
    "run_report",
    "run_report_merged",
    "run_report_table",
    "run_subsets",
    "run_timings",
]
