"""Churn data steps: derived columns, running totals, sorted and grouped listings."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import age_brought_forward, compact_date, date_of, round_all, safe_divide
from abacist.operators.aggregates import freq_table, group_total, means_long
from abacist.operators.ordered import running_total
from abacist.operators.prep import relabel
from abacist.operators.relational import order

DOLLARS_PER_UNIT = 1.15
SNAPSHOT = date(2011, 1, 24)


def derived_columns(df: DataFrame, as_of: date) -> DataFrame:
    """Dollars, mean purchase, snapshot date and its text, joined id, age today, loyalty label."""
    return df.withColumns({
        "mon_purch_dol": F.col("mon_purch") * DOLLARS_PER_UNIT,
        "avg_mon_purch": safe_divide("mon_purch", "freq_purch"),
        "snapshot_date": date_of(SNAPSHOT.year, SNAPSHOT.month, SNAPSHOT.day),
        "cust_id2": F.concat(F.col("cust_id").cast("string"), F.col("churn").cast("string")),
        "age2": age_brought_forward("age", F.lit(SNAPSHOT), F.lit(as_of)),
        "LOS2": relabel("LOS", 100, "loyal", "regular"),
    }).withColumn("snapshot_text", compact_date("snapshot_date"))


def run_churn_steps(df: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """The sixteen steps; ``cust_id`` is the row order the totals run in."""
    known = F.col("d_age_missing") == 0
    return {
        "derived": derived_columns(df, as_of),
        "known_age": df.where(known),
        "total_kept": running_total(df, [], ["cust_id"], "freq_purch", "tot_freq_purch", "propagate"),
        "total_sum": running_total(df, [], ["cust_id"], "freq_purch", "tot_freq_purch", "skip"),
        "rounded": df.withColumns(round_all(["age", "LOS", "rec_complaints"])),
        "loyal_first": order(df.where(F.col("d_age_missing") == 1), ("LOS", True), ("rec_complaints", False)),
        "loyal_ids": df.where(known & (F.col("LOS") > 100)).select("cust_id"),
        "spent_by_churn": group_total(df, "churn", "mon_purch", known & (F.col("LOS") > 310), "mon_purch"),
        "stats_by_gender": means_long(df, "d_gender", "mon_purch"),
        "gender_by_churn": freq_table(df, "d_gender", "churn"),
    }
