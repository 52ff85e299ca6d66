"""Ad KPI fact over all markets: main KPIs, action pivot, even split over content ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from abacist.functions.scalars import later, map_value, safe_divide, try_cast
from abacist.operators.aggregates import ActionRule, conditional_sums, group_rows
from abacist.sources.tables import append, union_sources

# Account to currency
CURRENCY_OF_ACCOUNT = {
    "1051855731553497": "SAR",
    "1042983862440684": "AED",
}

T, C = "actiontype", "ActionCollection"

# Output column and the tests of which one must hold
ACTION_RULES = (
    ActionRule("add_to_wishlist", ((C, "contains", "add_to_wishlist"),)),
    ActionRule("Leads", ((T, "contains", "lead"),)),
    ActionRule("Offsite_customed_leads", (
        (T, "prefix", "offsite_conversion.custom"), (T, "contains", "offsite_conversion.fb_pixel_custom"))),
    ActionRule("Post_Saves", ((T, "contains", "post_save"),)),
    ActionRule("Registration_completed", ((T, "contains", "complete_registration"),)),
    ActionRule("Post_shares", ((T, "exact", "post"),)),
    ActionRule("Post_comments", ((T, "exact", "comment"),)),
    ActionRule("Location_searches", ((T, "exact", "find_location_total"),)),
    ActionRule("Website_location_searches", ((T, "exact", "find_location_website"),)),
    ActionRule("Event_responses", ((T, "exact", "rsvp"),)),
    ActionRule("Pages_like", ((T, "exact", "like"),)),
    ActionRule("Messaging_conversations_started", (
        (T, "exact", "onsite_conversion.messaging_conversation_started_7d"),
        (T, "exact", "onsite_conversion.messaging_first_reply"))),
    ActionRule("Page_engagement", ((T, "exact", "page_engagement"),)),
    ActionRule("Post_reactions", ((T, "exact", "post_reaction"),)),
    ActionRule("Content_views", ((T, "exact", "%view_content%"),)),
    ActionRule("Landing_page_views", ((T, "exact", "landing_page_view"),)),
    ActionRule("Videos_view_3s", ((T, "exact", "video_view"),)),
    ActionRule("Page_photo_views", ((T, "exact", "photo_view"),)),
    ActionRule("Blocked_messaging_conversations", ((T, "exact", "onsite_conversion.messaging_block"),)),
    ActionRule("Message_to_buy", ((T, "exact", "onsite_conversion.message_to_buy"),)),
    ActionRule("Video_plays_50", ((C, "exact", "VideoP50WatchedActions"),)),
    ActionRule("Video_plays_15", ((C, "exact", "Video15_secWatchedActions"),)),
    ActionRule("Video_plays_100", ((C, "exact", "VideoP100_watchedActions"),)),
    ActionRule("Video_plays_25", ((C, "exact", "VideoP25WatchedActions"),)),
    ActionRule("Video_plays_95", ((C, "exact", "VideoP95WatchedActions"),)),
    ActionRule("Video_plays_75", ((C, "exact", "VideoP75WatchedActions"),)),
    ActionRule("Video_plays", ((C, "exact", "VideoPlayActions"),)),
)

MAIN_KPIS = {
    "impressions": "Impressions",
    "clicks": "Clicks",
    "spends_local": "Spend",
    "link_clicks": "LinkClicks",
    "post_engagements": "PostEngagements",
}
IDS = {"account_id": "AdAccountId", "campaign_id": "CampaignId", "adset_id": "AdSetId", "ad_id": "AdId"}
SHARED = ["date", "account_id", "campaign_id", "adset_id", "ad_id"]
SPLIT_KEYS = ["date", "ad_id", "platform", "objective"]


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("DateStart", "date").withColumns({k: try_cast(v, "long") for k, v in IDS.items()})


def _last_change():
    return F.max(later("gravity_inserted", "gravity_updated"))


def main_kpis(insights: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """One row per ad, day, platform and objective with summed KPIs; only rows with impressions."""
    keyed = _keyed(insights).withColumn("currency", map_value(F.ltrim("AdAccountId"), CURRENCY_OF_ACCOUNT))
    keys = [*extra, *SHARED, F.col("PublisherPlatform").alias("platform"), F.col("Objective").alias("objective"), "currency"]
    return keyed.groupBy(*keys).agg(
        *[F.sum(src).alias(name) for name, src in MAIN_KPIS.items()], _last_change().alias("a_modified")
    ).where(F.col("impressions") > 0)


def action_kpis(actions: DataFrame, rules: Sequence[ActionRule] = ACTION_RULES, extra: Sequence[str] = ()) -> DataFrame:
    """One row per ad and day with one summed column per action rule."""
    return conditional_sums(
        _keyed(actions), [*extra, *SHARED], rules, "ActionValue", _last_change().alias("b_modified")
    )


def ad_fact(
    insights: DataFrame, actions: DataFrame, bridge: DataFrame, rules: Sequence[ActionRule] = ACTION_RULES,
    extra: Sequence[str] = (), keep_duplicates: bool = False,
) -> DataFrame:
    """KPI fact with every measure split evenly over the content ids of an ad.

    The (ad_id, cid) bridge is made unique first, so sums over content ids equal the unsplit sums;
    ``keep_duplicates`` counts a measure once per repeated bridge row. Ids that are no numbers are null
    and never match, as in SQL. Action sums have no platform and repeat on every platform of an ad.

    The rows that share a measure are the KPI rows of the split key times the ad's content ids. Both
    counts come from small aggregates, so measures are divided before the join that fans them out and
    the fanned-out rows are never grouped again.
    """
    extra = list(extra)
    cids = bridge.where(F.col("cid").isNotNull()).groupBy("ad_id", "cid").agg(F.count(F.lit(1)).alias("__copies"))
    per_ad = cids.groupBy("ad_id").agg(F.count(F.lit(1)).alias("__cids"))
    main = group_rows(main_kpis(insights, extra), [*extra, *SPLIT_KEYS], "__rows")
    rows = main.join(action_kpis(actions, rules, extra), [*extra, *SHARED], "left").join(per_ad, "ad_id", "left")
    measures = [*MAIN_KPIS, *[r.name for r in rules]]
    keys = [*extra, *SHARED, "platform", "objective", "currency"]
    share = F.col("__rows") * F.coalesce("__cids", F.lit(1))
    split = rows.select(
        *keys, *[safe_divide(F.col(m), share).alias(m) for m in measures],
        later("a_modified", "b_modified").alias("last_modified"),
    ).join(cids, "ad_id", "left")
    copies = F.coalesce("__copies", F.lit(1)) if keep_duplicates else F.lit(1)
    return split.select(*keys, "cid", *[(F.col(m) * copies).alias(m) for m in measures], "last_modified")


def run_ad_kpi(
    spark: SparkSession, markets: Sequence[str], bridge: DataFrame, target: str | None = None,
    templates: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fact of all markets as one plan; appended to ``target`` when given."""
    names = dict(templates or {"insights": "fb_amio_{tag}_adinsights", "actions": "fb_amio_{tag}_adinsightsactions"})
    fact = ad_fact(
        union_sources(spark, names["insights"], markets), union_sources(spark, names["actions"], markets), bridge,
        extra=["market"],
    )
    if target:
        append(fact, target)
    return fact
