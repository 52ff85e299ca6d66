from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from abacist.operators.aggregates import conditional_sums
from abacist.plans import ad_kpi

DAY, T1, T2, T3 = date(2024, 1, 1), datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10)
INSIGHTS = (
    "DateStart date, AdAccountId string, CampaignId string, AdSetId string, AdId string, PublisherPlatform string, Objective string, "
    "Impressions long, Clicks long, Spend double, LinkClicks long, PostEngagements long, gravity_inserted timestamp, gravity_updated timestamp"
)
ACTIONS = (
    "DateStart date, AdAccountId string, CampaignId string, AdSetId string, AdId string, ActionCollection string, actiontype string, "
    "ActionValue string, gravity_inserted timestamp, gravity_updated timestamp"
)


def make(frame):
    ids = (DAY, " 1051855731553497", "1", "2")
    insights = frame(
        [
            (*ids, "10", "facebook", "reach", 100, 10, 5.0, 4, 2, T1, None),
            (*ids, "10", "facebook", "reach", 50, 0, 1.0, 0, 0, T1, T2),
            (*ids, "11", "facebook", "reach", 7, 1, 1.0, 1, 1, T1, None),
            (*ids, "12", "facebook", "reach", 0, 1, 1.0, 1, 1, T1, None),
            (*ids[:3], "none", "13", "facebook", "reach", 3, 1, 1.0, 1, 1, T1, None),
        ],
        INSIGHTS,
    )
    actions = frame(
        [
            (*ids, "10", "x_add_to_wishlist_y", "post", "4", T3, None),
            (*ids, "10", "VideoPlayActions", "onsite_conversion.messaging_first_reply", "6", T1, None),
            (*ids, "10", "VideoPlayActions", "comment", "not a number", T1, None),
            (*ids[:3], "none", "13", "VideoPlayActions", "like", "9", T3, None),
        ],
        ACTIONS,
    )
    bridge = frame([("10", "a"), ("10", "b"), ("10", "b"), ("11", None)], "ad_id string, cid string").withColumn(
        "ad_id", F.col("ad_id").cast("long")
    )
    return insights, actions, bridge


def test_ad_fact(frame):
    rows = {(r["ad_id"], r["cid"]): r for r in ad_kpi.ad_fact(*make(frame)).collect()}
    assert set(rows) == {(10, "a"), (10, "b"), (11, None), (13, None)}
    a = rows[(10, "a")]
    assert (a["impressions"], a["clicks"], a["currency"], a["last_modified"]) == (75.0, 5.0, "SAR", T3)
    assert (a["add_to_wishlist"], a["Post_shares"], a["Messaging_conversations_started"], a["Video_plays"]) == (2.0, 2.0, 3.0, 3.0)
    assert rows[(11, None)]["impressions"] == 7.0 and rows[(11, None)]["Video_plays"] is None
    assert rows[(11, None)]["last_modified"] == T1
    # an id that is no number is null and matches nothing
    assert rows[(13, None)]["adset_id"] is None and rows[(13, None)]["Pages_like"] is None


def test_split_sums_equal_unsplit_sums(frame):
    insights, actions, bridge = make(frame)
    fact = ad_kpi.ad_fact(insights, actions, bridge)
    total = insights.where("AdId <> '12'").agg(F.sum("Impressions"), F.sum("Spend")).first()
    got = fact.agg(F.sum("impressions"), F.sum("spends_local")).first()
    assert tuple(got) == pytest.approx(tuple(total))


def test_duplicate_bridge_rows_on_request(frame):
    rows = {(r["ad_id"], r["cid"]): r for r in ad_kpi.ad_fact(*make(frame), keep_duplicates=True).collect()}
    assert rows[(10, "a")]["impressions"] == 75.0 and rows[(10, "b")]["impressions"] == 150.0


def test_rules_cover_every_output(frame):
    assert len(ad_kpi.ACTION_RULES) == 27 and len(ad_kpi.MAIN_KPIS) == 5
    df = frame([("k", "%view_content%", "c", "3"), ("k", "view_content", "c", "5")], "k string, actiontype string, ActionCollection string, v string")
    assert conditional_sums(df, ["k"], ad_kpi.ACTION_RULES, "v").first()["Content_views"] == 3


def test_markets_append_to_a_target(spark, frame, tmp_path):
    insights, actions, bridge = make(frame)
    for m in ("uae", "ksa"):
        insights.createOrReplaceTempView(f"fb_amio_{m}_adinsights")
        actions.createOrReplaceTempView(f"fb_amio_{m}_adinsightsactions")
    fact = ad_kpi.run_ad_kpi(spark, ["uae", "ksa"], bridge)
    from abacist.sources.tables import ensure_table

    ensure_table(spark, "fact_t", fact.schema, path=str(tmp_path / "fact"))
    ad_kpi.run_ad_kpi(spark, ["uae", "ksa"], bridge, "fact_t")
    assert spark.table("fact_t").groupBy("market").count().collect().__len__() == 2
    assert spark.table("fact_t").count() == 8
