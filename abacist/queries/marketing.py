"""Marketing loads: action pivot, apportioned KPI fact, reloads, channel rollup, report payloads."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from abacist.functions.scalars import exact_sum, safe_divide, try_cast
from abacist.operators.aggregates import ActionRule, apportion, conditional_sums, group_rows
from abacist.plans import ad_kpi, ad_report, web_warehouse
from abacist.queries.registry import load, query, sum_sql
from abacist.session import shared_dir
from abacist.sources import nested, tables
from abacist.sources.reload import reload_window
from abacist.streaming.reload import follow


def _rule_sql(rules, columns):
    """The same rules as SQL conditions."""
    def test(c, mode, text):
        c = columns[c]
        return {
            "exact": f"{c} = '{text}'", "contains": f"contains({c}, '{text}')", "prefix": f"starts_with({c}, '{text}')",
        }[mode]

    return ", ".join(
        f"CAST(SUM(CASE WHEN {' OR '.join(test(*t) for t in r.tests)} THEN TRY_CAST(v AS BIGINT) ELSE 0 END) AS BIGINT) AS {r.name}"
        for r in rules
    )


EVENT_RULES = (
    ActionRule("errors", (("event_type", "contains", "err"),)),
    ActionRule("signups", (("event_type", "prefix", "sig"),)),
    ActionRule("clicks", (("event_type", "exact", "click"),)),
    ActionRule("reach", (("event_type", "exact", "view"), ("event_type", "prefix", "pur"))),
    ActionRule("literal", (("event_type", "exact", "%view%"),)),
)


@query(
    "action_pivot",
    f"""SELECT CAST(ts AS DATE) AS date, user_id, {_rule_sql(EVENT_RULES, {'event_type': 'event_type'})}
    FROM (SELECT *, CASE WHEN value > 100 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS v FROM events) GROUP BY 1, 2""",
)
def action_pivot(spark, sf):
    """Sums per day and user by action rule; a value that is no number is left out."""
    events = load(spark, sf, "events").select(
        F.to_date("ts").alias("date"), "user_id", "event_type",
        F.when(F.col("value") > 100, "n/a").otherwise(F.get_json_object("props", "$.k")).alias("v"),
    )
    return conditional_sums(events, ["date", "user_id"], EVENT_RULES, "v")


# Events as ads: user = ad, event type = objective, value decides the account; two markets by event type.
ACTION_OF_EVENT = {
    "click": "post", "view": "video_view", "signup": "lead_grouped",
    "purchase": "offsite_conversion.fb_pixel_custom", "error": "%view_content%",
}
MARKETS = {"uae": ["click", "view"], "ksa": ["signup", "purchase", "error"]}


def _register_ad_sources(spark, sf, run):
    events = load(spark, sf, "events")
    account = F.when(F.col("value") < 20, " 1051855731553497").when(F.col("value") < 60, "1042983862440684").otherwise("77")
    ids = [
        F.to_date("ts").alias("DateStart"),
        account.alias("AdAccountId"),
        F.length("event_type").cast("string").alias("CampaignId"),
        F.when(F.col("value") > 200, "unknown").otherwise("5").alias("AdSetId"),
        F.col("user_id").cast("string").alias("AdId"),
        F.col("ts").alias("gravity_inserted"),
        F.when(F.col("value") > 10, F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("gravity_updated"),
    ]
    k = F.get_json_object("props", "$.k")
    for market, kinds in MARKETS.items():
        mine = events.where(F.col("event_type").isin(kinds))
        mine.select(
            *ids,
            F.when(F.col("value") < 30, "facebook").otherwise("instagram").alias("PublisherPlatform"),
            F.col("event_type").alias("Objective"),
            k.cast("long").alias("Impressions"),
            F.floor("value").alias("Clicks"),
            F.floor(F.col("value") * 100).alias("Spend"),
            (k.cast("long") - 50).alias("LinkClicks"),
            F.hour("ts").cast("long").alias("PostEngagements"),
        ).createOrReplaceTempView(f"fb_amio_{market}{run}_adinsights")
        kind = F.create_map(*[F.lit(x) for kv in ACTION_OF_EVENT.items() for x in kv])[F.col("event_type")]
        mine.select(
            *ids, kind.alias("actiontype"),
            F.when(F.hour("ts") > 12, "VideoPlayActions").otherwise("add_to_wishlist_total").alias("ActionCollection"),
            F.when(F.col("value") > 150, "many").otherwise(k).alias("ActionValue"),
        ).createOrReplaceTempView(f"fb_amio_{market}{run}_adinsightsactions")
    return load(spark, sf, "customer").select(
        F.col("c_nationkey").cast("long").alias("ad_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("cid"),
    )


_ID_SQL = """CAST(ts AS DATE) AS date, CASE WHEN value < 20 THEN 1051855731553497 WHEN value < 60 THEN 1042983862440684 ELSE 77 END AS account_id,
  CAST(length(event_type) AS BIGINT) AS campaign_id, CASE WHEN value > 200 THEN NULL ELSE CAST(5 AS BIGINT) END AS adset_id, user_id AS ad_id,
  CASE WHEN event_type IN ('click', 'view') THEN 'uae' ELSE 'ksa' END AS market,
  CASE WHEN value > 10 THEN ts + INTERVAL 1 HOUR ELSE ts END AS changed"""
_MEASURES = [*ad_kpi.MAIN_KPIS, *[r.name for r in ad_kpi.ACTION_RULES]]
AD_FACT_SQL = f"""
WITH e AS (SELECT *, {_ID_SQL}, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN value > 150 THEN 'many' ELSE json_extract_string(props, '$.k') END AS v,
    CASE event_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in ACTION_OF_EVENT.items())} END AS actiontype,
    CASE WHEN hour(ts) > 12 THEN 'VideoPlayActions' ELSE 'add_to_wishlist_total' END AS collection FROM events),
a AS (SELECT market, date, account_id, campaign_id, adset_id, ad_id,
    CASE WHEN value < 30 THEN 'facebook' ELSE 'instagram' END AS platform, event_type AS objective,
    CASE account_id WHEN 1051855731553497 THEN 'SAR' WHEN 1042983862440684 THEN 'AED' END AS currency,
    CAST(SUM(k) AS BIGINT) AS impressions, CAST(SUM(floor(value)) AS BIGINT) AS clicks,
    CAST(SUM(floor(value * 100)) AS BIGINT) AS spends_local, CAST(SUM(k - 50) AS BIGINT) AS link_clicks,
    CAST(SUM(hour(ts)) AS BIGINT) AS post_engagements, MAX(changed) AS am FROM e GROUP BY ALL),
b AS (SELECT market, date, account_id, campaign_id, adset_id, ad_id, MAX(changed) AS bm,
    {_rule_sql(ad_kpi.ACTION_RULES, {'actiontype': 'actiontype', 'ActionCollection': 'collection'})} FROM e GROUP BY ALL),
c AS (SELECT DISTINCT c_nationkey AS ad_id, c_mktsegment AS cid FROM customer WHERE c_mktsegment <> 'MACHINERY'),
j AS (SELECT a.*, b.* EXCLUDE (market, date, account_id, campaign_id, adset_id, ad_id), cid,
    COUNT(*) OVER (PARTITION BY a.market, a.date, a.ad_id, platform, objective)::DOUBLE AS split
    FROM a LEFT JOIN b USING (market, date, account_id, campaign_id, adset_id, ad_id) LEFT JOIN c ON c.ad_id = a.ad_id
    WHERE impressions > 0)
SELECT market, date, account_id, campaign_id, adset_id, ad_id, platform, objective, currency, cid,
    {', '.join(f'{m}::DOUBLE / split AS {m}' for m in _MEASURES)}, GREATEST(am, bm) AS last_modified FROM j
"""


@query("ad_kpi_fact", AD_FACT_SQL)
def ad_kpi_fact(spark, sf):
    """Both markets' KPI fact in one plan: 32 measures split over content ids."""
    run = uuid.uuid4().hex[:8]
    bridge = _register_ad_sources(spark, sf, run)
    return ad_kpi.run_ad_kpi(
        spark, list(MARKETS), bridge,
        templates={"insights": "fb_amio_{tag}" + run + "_adinsights", "actions": "fb_amio_{tag}" + run + "_adinsightsactions"},
    )


@query(
    "kpi_apportioned",
    """WITH s AS (SELECT l_partkey, l_suppkey, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2)
    SELECT l_partkey, l_suppkey, quantity::DOUBLE / COUNT(*) OVER (PARTITION BY l_partkey)::DOUBLE AS quantity,
    COUNT(*) OVER (PARTITION BY l_partkey) AS suppliers FROM s""",
)
def kpi_apportioned(spark, sf):
    sums = load(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").cast("long").alias("quantity"))
    return apportion(group_rows(sums, ["l_partkey"], "suppliers"), ["l_partkey"], ["quantity"])


@query(
    "market_union",
    f"""SELECT lower(substr(o_orderpriority, 3, 3)) AS market, o_orderstatus, COUNT(*) AS orders, {sum_sql('o_totalprice')} AS total
    FROM orders GROUP BY 1, 2""",
)
def market_union(spark, sf):
    """One table per market, the same aggregate over each, one plan."""
    run = uuid.uuid4().hex[:8]
    orders = load(spark, sf, "orders")
    markets = {"urg": "1-URGENT", "hig": "2-HIGH", "med": "3-MEDIUM", "not": "4-NOT SPECIFIED", "low": "5-LOW"}
    for tag, priority in markets.items():
        orders.where(F.col("o_orderpriority") == priority).createOrReplaceTempView(f"orders_{tag}_{run}")

    def per_status(df):
        return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").alias("total"))

    return tables.union_sources(spark, "orders_{tag}_" + run, list(markets), per_status)


@query(
    "table_discovery",
    f"""SELECT CASE WHEN event_type IN ('click', 'view') THEN 'uae' ELSE 'ksa' END AS country, COUNT(*) AS rows, {sum_sql('value')} AS value
    FROM events GROUP BY 1""",
)
def table_discovery(spark, sf):
    """Countries found in table names, then one aggregate over each country's table; decoys are passed over."""
    events = load(spark, sf, "events")
    run = uuid.uuid4().hex[:8]
    for country, kinds in MARKETS.items():
        events.where(F.col("event_type").isin(kinds)).createOrReplaceTempView(f"rs{run}_amio_market{country}_campaign")
    for decoy in (f"rs{run}_amio_marketfra_campaign_stage", f"rs{run}_other_marketdeu_campaign"):
        events.createOrReplaceTempView(decoy)
    found = tables.discover(spark, [f"rs{run}", "amio", "campaign"], ["stage"])
    countries = sorted(r["country"] for r in found.collect())

    def total(df):
        return df.agg(F.count(F.lit(1)).alias("rows"), exact_sum("value").alias("value"))

    return tables.union_sources(spark, f"rs{run}_amio_market" + "{tag}_campaign", countries, total, "country")


@query(
    "rolling_reload",
    f"""WITH d AS (SELECT CAST(ts AS DATE) AS date, event_type AS country, event_id, value FROM events)
    SELECT country, date, COUNT(*) AS rows, {sum_sql('value')} AS value FROM
    (SELECT * FROM d WHERE date < DATE '2024-01-20' OR date > DATE '2024-01-22'
     UNION ALL SELECT date, country, event_id, value + 1 FROM d WHERE date IN (DATE '2024-01-20', DATE '2024-01-22') AND country <> 'error')
    GROUP BY 1, 2""",
)
def rolling_reload(spark, sf):
    """First load, then a reload of 20 to 22 January whose source has nothing for the 21st, run twice."""
    run = uuid.uuid4().hex
    target = f"reloaded_{run}"
    events = load(spark, sf, "events").select(
        "event_id", "value", F.to_date("ts").alias("date"), F.col("event_type").alias("country")
    )
    tables.ensure_table(spark, target, events.schema, ["date", "country"], f"{shared_dir(spark)}/{target}")
    reload_window(events, target, "date", date(2024, 1, 31), 40)
    late = events.where((F.col("date") != F.lit(date(2024, 1, 21))) & (F.col("country") != "error")).withColumn(
        "value", F.col("value") + 1
    )
    for _ in range(2):
        reload_window(late, target, "date", date(2024, 1, 22), 2)
    return spark.table(target).groupBy("country", "date").agg(
        F.count(F.lit(1)).alias("rows"), exact_sum("value").alias("value")
    )


@query(
    "rolling_reload_scoped",
    """SELECT country, date, COUNT(*) AS rows FROM (SELECT CAST(ts AS DATE) AS date, event_type AS country FROM events)
    WHERE NOT (country = 'view' AND date BETWEEN DATE '2024-01-09' AND DATE '2024-01-10') GROUP BY 1, 2""",
)
def rolling_reload_scoped(spark, sf):
    """Reload of one country's window; the other countries' days stay."""
    run = uuid.uuid4().hex
    target = f"reloaded_{run}"
    events = load(spark, sf, "events").select("event_id", F.to_date("ts").alias("date"), F.col("event_type").alias("country"))
    tables.ensure_table(spark, target, events.schema, ["date", "country"], f"{shared_dir(spark)}/{target}")
    reload_window(events, target, "date", date(2024, 1, 31), 40)
    kept = events.where(F.col("date") < F.lit(date(2024, 1, 9)))
    reload_window(kept, target, "date", date(2024, 1, 10), 2, among={"country": ["view"]})
    return spark.table(target).groupBy("country", "date").agg(F.count(F.lit(1)).alias("rows"))


_CODE_SQL = """CASE event_type WHEN 'click' THEN 'ban_' WHEN 'view' THEN 'SM_' WHEN 'signup' THEN 'ps_' WHEN 'purchase' THEN 'banX' ELSE 'x' END
    || CAST(user_id AS VARCHAR)"""
_CHANNEL_SQL = """CASE WHEN starts_with(trackingcode, 'ban_') THEN 'display'
    WHEN starts_with(trackingcode, 'SM_') OR starts_with(trackingcode, 'sm_') THEN 'social'
    WHEN starts_with(trackingcode, 'PS_') OR starts_with(trackingcode, 'ps_') THEN 'marin' ELSE 'other' END"""


def _web_rows(spark, sf):
    return _web_columns(load(spark, sf, "events"))


def _web_columns(events):
    head = F.when(F.col("event_type") == "click", "ban_").when(F.col("event_type") == "view", "SM_").when(
        F.col("event_type") == "signup", "ps_").when(F.col("event_type") == "purchase", "banX").otherwise("x")
    k = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.to_date("ts").alias("date"),
        F.when(F.hour("ts") < 12, "de").otherwise("DE").alias("country"),
        F.concat(head, F.col("user_id").cast("string")).alias("trackingcode"),
        F.lit(1).cast("long").alias("bounces"), k.alias("pageviews"), F.floor("value").alias("uniquevisitors"),
        F.hour("ts").cast("long").alias("visits"),
        *[(k * i).alias(f"cm1006_{i}") for i in range(1, 22)],
    )


_WEB_SQL = f"""SELECT CAST(ts AS DATE) AS date, CASE WHEN hour(ts) < 12 THEN 'de' ELSE 'DE' END AS country, {_CODE_SQL} AS trackingcode,
  CAST(1 AS BIGINT) AS bounces, CAST(json_extract_string(props, '$.k') AS BIGINT) AS pageviews, CAST(floor(value) AS BIGINT) AS uniquevisitors,
  CAST(hour(ts) AS BIGINT) AS visits FROM events"""
_WEB_SUMS = "CAST(SUM(uniquevisitors) AS BIGINT) AS uniquevisitors, CAST(SUM(bounces) AS BIGINT) AS bounces, CAST(SUM(pageviews) AS BIGINT) AS pageviews, CAST(SUM(visits) AS BIGINT) AS visits"
_WEB_MEASURES = ", ".join(f"CAST(SUM(pageviews * {i}) AS BIGINT) AS \"{m}\"" for i, m in enumerate(web_warehouse.WAREHOUSE_MEASURES, 1))


@query(
    "channel_rollup",
    f"""SELECT date, UPPER(country) AS country, trackingcode, {_WEB_SUMS}, {_WEB_MEASURES}, {_CHANNEL_SQL} AS channel_type
    FROM ({_WEB_SQL}) w GROUP BY date, w.country, trackingcode""",
)
def channel_rollup(spark, sf):
    """Warehouse rows: grouped on the country as written, shown in upper case."""
    return web_warehouse.rollup(_web_rows(spark, sf))


@query(
    "web_warehouse",
    f"""SELECT date, UPPER(country) AS country, trackingcode, {_WEB_SUMS}, {_WEB_MEASURES}, {_CHANNEL_SQL} AS channel_type
    FROM (SELECT DISTINCT * FROM ({_WEB_SQL}) WHERE date BETWEEN DATE '2024-01-13' AND DATE '2024-01-15') w
    GROUP BY date, w.country, trackingcode""",
)
def web_warehouse_load(spark, sf):
    """Country sources to staging to warehouse, with the gate on the day before."""
    run = uuid.uuid4().hex[:8]
    rows = _web_rows(spark, sf)
    for iso in ("de", "DE"):
        # view names ignore case, so the two spellings get names of their own
        rows.where(F.col("country") == iso).drop("country").createOrReplaceTempView(f"src{run}_{_spelled(iso)}")
    staging, warehouse, as_of = f"staging_{run}", f"warehouse_{run}", date(2024, 1, 15)
    root = shared_dir(spark)
    parts = [
        web_warehouse.stage_rows(spark.table(f"src{run}_{_spelled(iso)}"), iso, as_of) for iso in ("de", "DE")
    ]
    tables.ensure_table(spark, staging, web_warehouse.STAGING_SCHEMA, ["date"], f"{root}/{staging}")
    reload_window(tables.append_rows(*parts), staging, "date", as_of, 2)
    web_warehouse.run_warehouse(spark, staging, warehouse, as_of, path=f"{root}/{warehouse}")
    return spark.table(warehouse)


@query(
    "stream_reload",
    f"""SELECT date, UPPER(country) AS country, trackingcode, {_WEB_SUMS}, {_WEB_MEASURES}, {_CHANNEL_SQL} AS channel_type
    FROM (SELECT DISTINCT * FROM ({_WEB_SQL})) w GROUP BY date, w.country, trackingcode""",
)
def stream_reload(spark, sf):
    """The events' web rows followed as a stream of files, then followed again with nothing new."""
    run = uuid.uuid4().hex
    root = shared_dir(spark)
    schema = load(spark, sf, "events").schema
    arriving = spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")
    names = [f"stream_{kind}_{run}" for kind in ("staging", "warehouse")]
    for _ in range(2):
        follow(spark, _web_columns(arriving), *names, f"{root}/stream_{run}", [f"{root}/{n}" for n in names])
    return spark.table(names[1])


def _spelled(iso):
    return ("upper" if iso.isupper() else "lower") + iso.lower()


@query(
    "report_flatten",
    """SELECT CAST(user_id AS VARCHAR) AS "itemId", CAST(ts AS DATE) AS "Date", CAST(json_extract_string(props, '$.k') AS DOUBLE) AS "metrics/visits",
    value AS "metrics/orders" FROM events""",
)
def report_flatten(spark, sf):
    """Report payloads built from the events, one per day, flattened to columns named by metric."""
    reports, mapping = _payloads(spark, sf)
    return nested.flatten_report(reports, mapping)


@query(
    "report_flatten_long",
    """SELECT CAST(user_id AS VARCHAR) AS "itemId", CAST(ts AS DATE) AS "Date", 'metrics/visits' AS metric,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value FROM events
    UNION ALL SELECT CAST(user_id AS VARCHAR), CAST(ts AS DATE), 'metrics/orders', value FROM events""",
)
def report_flatten_long(spark, sf):
    reports, mapping = _payloads(spark, sf)
    return nested.flatten_report_long(reports, spark.createDataFrame(mapping, "columnId string, id string"))


def _payloads(spark, sf):
    """Report payloads as the web service sends them: pages of at most a few hundred rows."""
    row = F.struct(
        F.col("user_id").cast("string").alias("itemId"),
        F.concat(F.to_date("ts").cast("string"), F.lit("T00:00:00")).alias("value"),
        F.array(F.get_json_object("props", "$.k").cast("double"), F.col("value")).alias("data"),
    )
    page = F.floor(F.col("event_id") / 200)
    reports = load(spark, sf, "events").groupBy(page.alias("page")).agg(F.collect_list(row).alias("rows")).select(
        F.struct(F.array(F.lit("0"), F.lit("1")).alias("columnIds")).alias("columns"), "rows"
    )
    return reports, [("0", "metrics/visits"), ("1", "metrics/orders")]


@query(
    "objects_flatten",
    "SELECT CAST(conv_id AS VARCHAR) AS rsid, role AS name, CAST(turn AS VARCHAR) AS currency FROM conversations",
)
def objects_flatten(spark, sf):
    """Arrays of objects, one array per conversation page, to rows with three of their keys."""
    item = F.struct(
        F.col("conv_id").cast("string").alias("rsid"), F.col("role").alias("name"),
        F.col("turn").cast("string").alias("currency"), F.length("text").alias("size"),
    )
    content = load(spark, sf, "conversations").groupBy("conv_id", F.floor(F.col("turn") / 100)).agg(
        F.collect_list(item).alias("content")
    )
    return nested.flatten_objects(content, "content", ["rsid", "name", "currency"])


@query(
    "report_cleanup",
    """SELECT CAST(ts AS DATE) AS "Date", event_type AS "Seat_name", CASE WHEN value > 100 THEN 0.0 ELSE value END AS "Budget_spent",
    CASE WHEN event_type = 'view' THEN 0 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS "Clicks"
    FROM events WHERE event_type <> 'error'""",
)
def report_cleanup(spark, sf):
    """Texts as delivered: quoted names, ISO days, missing counts, rows without a day."""
    raw = load(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("").alias("Day"),
        F.concat(F.lit('"'), F.col("event_type"), F.lit('"')).alias("Seat name"),
        F.when(F.col("value") <= 100, F.col("value").cast("string")).alias("Budget spent"),
        F.when(F.col("event_type") != "view", F.get_json_object("props", "$.k")).alias("Clicks"),
    )
    return ad_report.clean_report(raw)


@query(
    "report_ingest",
    """SELECT CAST(ts AS DATE) AS "Date", event_type || ', seat' AS "Seat_name", COUNT(*) AS rows,
    CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS clicks FROM events GROUP BY 1, 2""",
)
def report_ingest(spark, sf):
    """The events written as delivered CSV files, then scanned, cleaned, loaded and read back."""
    run = uuid.uuid4().hex
    root = shared_dir(spark)
    given = {
        "Day": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "Seat name": F.concat("event_type", F.lit(", seat")),
        "Clicks": F.get_json_object("props", "$.k"),
    }
    names = [*ad_report.TEXTS, "Budget spent", *ad_report.COUNTS]
    load(spark, sf, "events").select(
        *[given.get(n, F.lit(None).cast("string")).alias(n) for n in names]
    ).write.option("header", True).csv(f"{root}/report_{run}")
    loaded = ad_report.run_report_ingest(
        spark, f"{root}/report_{run}", f"ad_report_{run}", export_path=f"{root}/export_{run}", table_path=f"{root}/loaded_{run}"
    )
    return loaded.groupBy("Date", "Seat_name").agg(F.count(F.lit(1)).alias("rows"), F.sum("Clicks").alias("clicks"))


@query(
    "safe_numbers",
    """SELECT event_id, TRY_CAST(event_type AS BIGINT) AS no_number, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    value / NULLIF(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) - 50, 0) AS ratio FROM events""",
)
def safe_numbers(spark, sf):
    k = try_cast(F.get_json_object("props", "$.k"), "long")
    return load(spark, sf, "events").select(
        "event_id", try_cast("event_type", "long").alias("no_number"), k.alias("k"), safe_divide(F.col("value"), k - 50).alias("ratio")
    )
