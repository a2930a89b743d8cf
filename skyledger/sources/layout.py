"""Where tables, subsets, results and the run time log lie below one base folder."""

from __future__ import annotations

import re
from dataclasses import dataclass

FULL = "full"


def subset_name(subset: str | None) -> str:
    """``full`` for none, else the name as it is; a name of no subset is an error."""
    if subset is None or subset == FULL:
        return FULL
    if not re.fullmatch(r"pct_\d{3}", subset):
        raise ValueError(f"no subset: {subset}; {FULL}, or pct_ and three digits")
    return subset


@dataclass(frozen=True)
class Layout:
    base: str

    def _at(self, path: str) -> str:
        return f"{self.base.rstrip('/')}/{path}"

    @property
    def raw(self) -> str:
        return self._at("data/raw/flights.csv")

    @property
    def stages(self) -> str:
        """All rows that cleaning read, in one folder per stage."""
        return self._at("data/cleaned")

    @property
    def cleaned(self) -> str:
        return f"{self.stages}/stage=kept"

    @property
    def partials(self) -> str:
        """Partial aggregates of the cleaned flights, in one folder per month."""
        return self._at("data/partials")

    @property
    def timings(self) -> str:
        return self._at("data/outputs/timings")

    @property
    def timings_report(self) -> str:
        return self._at("data/outputs/final_report_timings")

    def flights(self, subset: str | None = None) -> str:
        name = subset_name(subset)
        return self.cleaned if name == FULL else self._at(f"data/subsets/{name}")

    def output(self, job: str, subset: str | None = None) -> str:
        return self._at(f"data/outputs/{job}/{subset_name(subset)}")
