"""Survival study of loans: static rows, event table, curves, tests and the hazard model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from abacist.operators import survival as S
from abacist.operators.prep import fill_value


def static_loans(episodes: DataFrame, id_col: str, sentinels: Sequence[str] = (), sentinel: float = -999) -> DataFrame:
    """One row per loan; missing values of the named columns take the sentinel first."""
    for c in sentinels:
        episodes = fill_value(episodes, c, sentinel)
    return S.episodic_to_static(episodes, id_col)


def run_survival(
    loans: DataFrame, time: str, event: str, group: str, first: object, at: Sequence[float], balance: str, p: float = 0.3
) -> dict[str, DataFrame]:
    """The study's tables by name."""
    split = S.split_by_quantile(loans, balance, p, "large_balance")
    km = S.cumulative_density(S.kaplan_meier(loans, time, event))
    return {
        "event_table": S.event_table(loans, time, event),
        "curve": km,
        "curve_by_group": S.kaplan_meier(loans, time, event, group),
        "survival_at": S.survival_at(km, at),
        "survival_at_by_balance": S.survival_at(
            S.kaplan_meier(split, time, event, "large_balance"), at, "large_balance"
        ),
        "logrank": S.logrank(loans, time, event, group, first),
    }
