"""Donor base table at a reference date, built the same way for training and test."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.functions.scalars import age_in_years, exact_mean
from abacist.operators.prep import (
    clip_sigma, fill_zero, gift_features, median_impute, null_flags, one_hot, ratios, segment, winsorize,
)
from abacist.operators.relational import flag_member
from abacist.session import materialise

SEGMENTS = ["Bronze", "Gold", "Regular", "Silver"]
RATIOS = {
    "ratio_month_year": ("last_month_mean", "year1_mean"),
    "ratio_year2year_mean": ("year1_mean", "year2_mean"),
    "ratio_year2year_count": ("year1_count", "year2_count"),
}
GIFT_COLUMNS = ["max", "min", "mean", "sum", "count"]
PERIODS = ["last_month_mean", "year1_mean", "year1_count", "year2_mean", "year2_count"]


def gift_table(gifts: DataFrame, ref: date) -> DataFrame:
    """Gift features, ratios and value segment per donor known at the reference date."""
    overall = gifts.where(F.col("date") <= F.lit(ref)).agg(exact_mean("amount")).scalar()
    features = gift_features(gifts, "donorID", "amount", "date", ref)
    return ratios(features, RATIOS).withColumn("segment", segment("mean", "count", overall))


def campaign_targets(gifts: DataFrame, campaign: object) -> DataFrame:
    """Donors who gave to the campaign."""
    paid = gifts.where(F.col("campaignID") == F.lit(campaign)).groupBy("donorID").agg(F.sum("amount").alias("amount"))
    return paid.where(F.col("amount") > 0).select("donorID")


def donor_basetable(
    donors: DataFrame, gifts: DataFrame, selection: DataFrame, ref: date, campaign: object,
    categories: Mapping[str, Sequence[str]], upper: float = 0.04,
) -> DataFrame:
    """Every selected donor with features, dummies, cleaned numbers and the campaign target.

    The rows needed for medians, limits and winsorizing are written once and reused.
    """
    profile = donors.withColumn("age", age_in_years("dateOfBirth", F.lit(ref))).select("donorID", "age", *categories)
    base = (
        selection.select("donorID").distinct()
        .join(gift_table(gifts, ref), "donorID", "left")
        .join(profile, "donorID", "left")
    )
    base = one_hot(base, "segment", SEGMENTS, drop_first=True)
    for col, values in categories.items():
        base = one_hot(base, col, values, drop_first=True, nan=True)
    base = fill_zero(base, [*GIFT_COLUMNS[:4], "count", *PERIODS, *RATIOS])
    base = materialise(flag_member(base, campaign_targets(gifts, campaign), "donorID", "target"))
    base = median_impute(null_flags(base, ["recency_days", "age"], "_NA"), ["recency_days", "age"])
    base = clip_sigma(base, "age", 3.0, "age_no_outliers").drop("age")
    return winsorize(base, ["mean", "sum", "max", "min"], upper=upper)
