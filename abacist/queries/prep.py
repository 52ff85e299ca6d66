"""Base-table preparation: driver and donor tables, missing values, outliers, dummies, splits."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from abacist.operators import aggregates as A
from abacist.operators import evaluate as E
from abacist.operators import prep as D
from abacist.operators import sampling as K
from abacist.operators.timeseries import period
from abacist.plans.churn_steps import derived_columns, run_churn_steps
from abacist.plans.donor_basetable import donor_basetable, gift_table
from abacist.plans.driver_basetable import driver_basetable
from abacist.queries.registry import load, mean_sql, query, sum_sql
from abacist.sources.tables import append_rows

REF = date(1999, 9, 4)
FLAGS = ["A", "N", "R"]


@query(
    "driver_basetable",
    f"""
WITH r AS (SELECT *, CASE WHEN l_discount >= 0.095 THEN NULL ELSE l_extendedprice END AS ms FROM lineitem),
res AS (SELECT l_suppkey AS "driverId", {sum_sql('l_quantity')} AS "TotalDriverPoints", ROUND({mean_sql('l_linenumber')}, 2) AS "avgLaps",
    ROUND({mean_sql('l_tax')}, 2) AS speed, COUNT(CASE WHEN l_linestatus = 'F' THEN 1 END) AS fin,
    COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS "fastestLapTime_NA", COUNT(*) - COUNT(ms) AS "finalMilliseconds_NA",
    COUNT(CASE WHEN l_linenumber <= 5 THEN 1 END) AS "fastestLapRank_5", COUNT(*) AS "NbrOfRace",
    COUNT(CASE WHEN l_returnflag = 'A' THEN 1 END) AS "constructor_A", COUNT(CASE WHEN l_returnflag = 'N' THEN 1 END) AS "constructor_N",
    COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS "constructor_R" FROM r GROUP BY 1),
pit AS (SELECT l_suppkey AS "driverId", ROUND({mean_sql('l_extendedprice')}, 2) AS dur, COUNT(l_linenumber) AS stops FROM lineitem
    WHERE l_returnflag = 'A' AND l_quantity > 45 GROUP BY 1),
lap AS (SELECT l_suppkey AS "driverId", CAST(MAX(2018 - year(o_orderdate)) AS INTEGER) AS diff, {mean_sql('l_quantity')} AS laptime
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
n AS (SELECT s_nationkey, COUNT(*) AS freq FROM supplier GROUP BY 1)
SELECT s_suppkey AS "driverId", freq AS "driverNationality", COALESCE(dur, 0) AS "avgPitStopDuration", COALESCE(stops, 0) AS "NbrOfStops",
    COALESCE(diff, 0) AS "raceYearDiff", COALESCE(laptime, 0) AS "avgLapTime",
    COALESCE("TotalDriverPoints", 0) AS "TotalDriverPoints", COALESCE("avgLaps", 0) AS "avgLaps", COALESCE(speed, 0) AS "avgFastestLapSpeed",
    COALESCE("fastestLapTime_NA", 0) AS "fastestLapTime_NA", COALESCE("finalMilliseconds_NA", 0) AS "finalMilliseconds_NA",
    COALESCE("fastestLapRank_5", 0) AS "fastestLapRank_5", COALESCE("NbrOfRace", 0) AS "NbrOfRace",
    COALESCE("constructor_A", 0) AS "constructor_A", COALESCE("constructor_N", 0) AS "constructor_N", COALESCE("constructor_R", 0) AS "constructor_R",
    CAST(CASE WHEN "NbrOfRace" IS NULL THEN 0 WHEN speed IS NULL THEN 1 ELSE 0 END AS INTEGER) AS "avgFastestLapSpeed_NA",
    CAST(dur IS NULL AS INTEGER) AS "avgPitStopDuration_NA", CAST(stops IS NULL AS INTEGER) AS "NbrOfStops_NA",
    CAST(diff IS NULL AS INTEGER) AS "raceYearDiff_NA", CAST(laptime IS NULL AS INTEGER) AS "avgLapTime_NA",
    COALESCE(COALESCE(stops, 0)::DOUBLE / "NbrOfRace", 0) AS "ratioStops", CAST(CASE WHEN fin >= 1 THEN 1 ELSE 0 END AS INTEGER) AS target,
    CAST(CASE WHEN stops >= 2 * "NbrOfRace" THEN 2 WHEN stops >= "NbrOfRace" THEN 1 ELSE 0 END AS INTEGER) AS "stopCat"
FROM supplier JOIN n USING (s_nationkey) LEFT JOIN pit ON pit."driverId" = s_suppkey LEFT JOIN lap ON lap."driverId" = s_suppkey
LEFT JOIN res ON res."driverId" = s_suppkey
""",
)
def driver_table(spark, sf):
    """Suppliers as drivers, line items as results, laps and pit stops, orders as races."""
    items = load(spark, sf, "lineitem")
    drivers = load(spark, sf, "supplier").select(F.col("s_suppkey").alias("driverId"), F.col("s_nationkey").alias("nationality"))
    results = items.select(
        F.col("l_suppkey").alias("driverId"), F.col("l_orderkey").alias("raceId"), F.col("l_quantity").alias("points"),
        F.col("l_linenumber").alias("laps"), F.col("l_linenumber").alias("rank"), F.col("l_tax").alias("fastestLapSpeed"),
        F.when(F.col("l_discount") < 0.095, F.col("l_extendedprice")).alias("milliseconds"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("fastestLapTime"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("statusId"), F.col("l_returnflag").alias("constructorId"),
    )
    pits = items.where((F.col("l_returnflag") == "A") & (F.col("l_quantity") > 45)).select(
        F.col("l_suppkey").alias("driverId"), F.col("l_linenumber").alias("stop"), F.col("l_extendedprice").alias("milliseconds")
    )
    races = load(spark, sf, "orders").select(F.col("o_orderkey").alias("raceId"), F.year("o_orderdate").alias("year"))
    laps = items.select(
        F.col("l_suppkey").alias("driverId"), F.col("l_orderkey").alias("raceId"), F.col("l_quantity").alias("milliseconds")
    )
    return driver_basetable(drivers, results, pits, races, laps, FLAGS)


@query(
    "category_pivot",
    """SELECT l_suppkey, COUNT(*) FILTER (l_returnflag = 'A') AS "flag_A", COUNT(*) FILTER (l_returnflag = 'N') AS "flag_N",
    COUNT(*) FILTER (l_returnflag = 'R') AS "flag_R" FROM lineitem GROUP BY 1""",
)
def category_pivot(spark, sf):
    return A.pivot_count(load(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", FLAGS, "flag_")


@query(
    "freq_encode",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 0 ELSE COUNT(*) OVER (PARTITION BY l_returnflag) END AS flag FROM lineitem""",
)
def freq_encode(spark, sf):
    """Three categories over all line items, one of them missing."""
    rows = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag")
    )
    return A.freq_encode(rows, "flag")


def _gifts(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_custkey").alias("donorID"), F.col("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("campaignID"),
    )


def _period_mean(cond):
    return mean_sql(f"(CASE WHEN {cond} THEN amount END)")


_MONTH = "date BETWEEN DATE '1999-08-04' AND DATE '1999-09-04'"
_YEAR1 = "date BETWEEN DATE '1998-09-04' AND DATE '1999-09-04'"
_YEAR2 = "date >= DATE '1997-09-04' AND date < DATE '1998-09-04'"
GIFT_SQL = f"""
WITH gifts AS (SELECT o_custkey AS "donorID", o_totalprice AS amount, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS campaign FROM orders),
known AS (SELECT * FROM gifts WHERE date <= DATE '1999-09-04'),
overall AS (SELECT {mean_sql('amount')} AS g FROM known),
f AS (SELECT "donorID", MAX(amount) AS max, MIN(amount) AS min, {mean_sql('amount')} AS mean, {sum_sql('amount')} AS sum, COUNT(amount) AS count,
    CAST(date_diff('day', MAX(date), DATE '1999-09-04') AS INTEGER) AS recency_days,
    {_period_mean(_MONTH)} AS last_month_mean, {_period_mean(_YEAR1)} AS year1_mean, NULLIF(COUNT(CASE WHEN {_YEAR1} THEN 1 END), 0) AS year1_count,
    {_period_mean(_YEAR2)} AS year2_mean, NULLIF(COUNT(CASE WHEN {_YEAR2} THEN 1 END), 0) AS year2_count FROM known GROUP BY 1),
t AS (SELECT *, last_month_mean / NULLIF(year1_mean, 0) AS ratio_month_year, year1_mean / NULLIF(year2_mean, 0) AS ratio_year2year_mean,
    year1_count::DOUBLE / NULLIF(year2_count, 0)::DOUBLE AS ratio_year2year_count,
    CASE WHEN mean > 1.5 * g AND count >= 5 THEN 'Gold' WHEN mean >= g AND count >= 3 THEN 'Silver'
      WHEN mean > 0.5 * g AND count >= 3 THEN 'Bronze' ELSE 'Regular' END AS segment FROM f, overall)
"""


@query("rfm_basetable", GIFT_SQL + "SELECT * EXCLUDE (g) FROM t")
def rfm_basetable(spark, sf):
    """Recency, frequency, monetary value, window features, ratios and segment in one pass over the orders."""
    return gift_table(_gifts(spark, sf), REF)


@query(
    "window_features",
    GIFT_SQL + "SELECT \"donorID\", last_month_mean, year1_mean, year1_count, year2_mean, year2_count FROM f",
)
def window_features(spark, sf):
    gifts = _gifts(spark, sf).where(F.col("date") <= F.lit(REF))
    return gifts.groupBy("donorID").agg(*D.window_features("amount", "date", REF))


_BASE_SQL = GIFT_SQL + """,
donors AS (SELECT c_custkey AS "donorID", CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE
    ROUND(date_diff('day', DATE '1930-01-01' + CAST(floor(c_acctbal) AS INTEGER), DATE '1999-09-04') / 365.0::DOUBLE, 1) END AS age,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS seg FROM customer),
b AS (SELECT d."donorID", t.* EXCLUDE ("donorID", g), age, seg FROM donors d LEFT JOIN t ON t."donorID" = d."donorID"),
lim AS (SELECT quantile_cont(age, 0.5) AS age50, quantile_cont(recency_days, 0.5) AS rec50 FROM b),
i AS (SELECT b.*, COALESCE(age, age50) AS age2, COALESCE(CAST(recency_days AS DOUBLE), rec50) AS rec2 FROM b, lim),
w AS (SELECT AVG(age2) AS m, STDDEV_SAMP(age2) AS s, quantile_disc(COALESCE(mean, 0), 0.96) AS mean96, quantile_disc(COALESCE(sum, 0), 0.96) AS sum96,
    quantile_disc(COALESCE(max, 0), 0.96) AS max96, quantile_disc(COALESCE(min, 0), 0.96) AS min96 FROM i)
SELECT "donorID", LEAST(COALESCE(max, 0), max96) AS max, LEAST(COALESCE(min, 0), min96) AS min, LEAST(COALESCE(mean, 0), mean96) AS mean,
    LEAST(COALESCE(sum, 0), sum96) AS sum, COALESCE(count, 0) AS count, rec2 AS recency_days, COALESCE(last_month_mean, 0) AS last_month_mean,
    COALESCE(year1_mean, 0) AS year1_mean, COALESCE(year1_count, 0) AS year1_count, COALESCE(year2_mean, 0) AS year2_mean,
    COALESCE(year2_count, 0) AS year2_count, COALESCE(ratio_month_year, 0) AS ratio_month_year,
    COALESCE(ratio_year2year_mean, 0) AS ratio_year2year_mean, COALESCE(ratio_year2year_count, 0) AS ratio_year2year_count,
    CAST(COALESCE(segment = 'Gold', FALSE) AS INTEGER) AS "segment_Gold", CAST(COALESCE(segment = 'Regular', FALSE) AS INTEGER) AS "segment_Regular",
    CAST(COALESCE(segment = 'Silver', FALSE) AS INTEGER) AS "segment_Silver",
    CAST(COALESCE(seg = 'BUILDING', FALSE) AS INTEGER) AS "province_BUILDING", CAST(COALESCE(seg = 'FURNITURE', FALSE) AS INTEGER) AS "province_FURNITURE",
    CAST(COALESCE(seg = 'HOUSEHOLD', FALSE) AS INTEGER) AS "province_HOUSEHOLD", CAST(seg IS NULL AS INTEGER) AS "province_NaN",
    CAST("donorID" IN (SELECT "donorID" FROM gifts WHERE campaign = '1-URGENT') AS INTEGER) AS target,
    CAST(recency_days IS NULL AS INTEGER) AS "recency_days_NA", CAST(age IS NULL AS INTEGER) AS "age_NA",
    ROUND(LEAST(GREATEST(age2, m - s * 3), m + s * 3), 6) AS age_no_outliers
FROM i, w
"""


@query("donor_basetable", _BASE_SQL)
def donor_table(spark, sf):
    """The whole donor table: features, dummies, imputation, clipping, winsorizing, target."""
    customer = load(spark, sf, "customer")
    donors = customer.select(
        F.col("c_custkey").alias("donorID"),
        F.when(
            F.col("c_mktsegment") != "FURNITURE",
            F.date_add(F.lit(date(1930, 1, 1)), F.floor("c_acctbal").cast("int")),
        ).alias("dateOfBirth"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("province"),
    )
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]
    return donor_basetable(
        donors, _gifts(spark, sf), donors.select("donorID"), REF, "1-URGENT", {"province": segments}
    ).withColumn("age_no_outliers", F.round("age_no_outliers", 6))


@query("target_incidence", "SELECT ROUND(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::DOUBLE / COUNT(*), 3) AS incidence FROM orders")
def target_incidence(spark, sf):
    return E.incidence(load(spark, sf, "orders").withColumn("target", (F.col("o_orderstatus") == "F").cast("int")), "target")


@query(
    "one_hot",
    """SELECT c_custkey, CAST(COALESCE(seg = 'BUILDING', FALSE) AS INTEGER) AS "seg_BUILDING", CAST(COALESCE(seg = 'HOUSEHOLD', FALSE) AS INTEGER) AS "seg_HOUSEHOLD",
    CAST(seg IS NULL AS INTEGER) AS "seg_NaN" FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS seg FROM customer)""",
)
def one_hot(spark, sf):
    rows = load(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("seg")
    )
    return D.one_hot(rows, "seg", ["AUTOMOBILE", "BUILDING", "HOUSEHOLD"], drop_first=True, nan=True)


@query(
    "segment",
    GIFT_SQL + "SELECT segment, COUNT(*) AS donors FROM t GROUP BY 1",
)
def segment(spark, sf):
    return gift_table(_gifts(spark, sf), REF).groupBy("segment").agg(F.count(F.lit(1)).alias("donors"))


@query("ratios", GIFT_SQL + "SELECT \"donorID\", COALESCE(ratio_month_year, 0) AS a, COALESCE(ratio_year2year_count, 0) AS b FROM t")
def ratios(spark, sf):
    table = gift_table(_gifts(spark, sf), REF).select("donorID", "last_month_mean", "year1_mean", "year1_count", "year2_count")
    pairs = {"a": ("last_month_mean", "year1_mean"), "b": ("year1_count", "year2_count")}
    return D.ratios(table, pairs, fill=0.0).select("donorID", "a", "b")


@query(
    "ratio_classes",
    """SELECT c_custkey, CAST(CASE WHEN r >= 2 THEN 2 WHEN r >= 1 THEN 1 ELSE 0 END AS INTEGER) AS class, CAST(CASE WHEN n >= 10 THEN 1 ELSE 0 END AS INTEGER) AS often
    FROM (SELECT c_custkey, n, f::DOUBLE / n AS r FROM customer LEFT JOIN (SELECT o_custkey, COUNT(*) AS n,
      3 * COUNT(*) FILTER (o_orderstatus = 'F') AS f FROM orders GROUP BY 1) ON o_custkey = c_custkey)""",
)
def ratio_classes(spark, sf):
    per = load(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), (F.count_if(F.col("o_orderstatus") == "F") * 3).alias("f")
    )
    rows = D.ratios(load(spark, sf, "customer", "c_custkey").join(per, "c_custkey", "left"), {"r": ("f", "n")})
    return rows.select("c_custkey", D.bucket("r", [0, 1, 2]).alias("class"), D.label_at_least("n", 10).alias("often"))


def _holed(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price")
    )


_HOLED = "(SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders)"


@query(
    "median_impute",
    f"""SELECT o_orderkey, COALESCE(price, (SELECT quantile_cont(price, 0.5) FROM {_HOLED})) AS price,
    CAST(price IS NULL AS INTEGER) AS "price_NA" FROM {_HOLED}""",
)
def median_impute(spark, sf):
    return D.median_impute(_holed(spark, sf), ["price"], flag=True)


@query("fill_values", f"SELECT o_orderkey, COALESCE(price, 0) AS price, COALESCE(price, -999) AS marked FROM {_HOLED}")
def fill_values(spark, sf):
    rows = _holed(spark, sf).withColumn("marked", F.col("price"))
    return D.fill_zero(D.fill_value(rows, "marked", -999), ["price"])


@query(
    "clip_3sigma",
    """SELECT event_id, ROUND(LEAST(GREATEST(value, m - 3 * s), m + 3 * s), 6) AS value
    FROM events, (SELECT AVG(value) AS m, STDDEV_SAMP(value) AS s FROM events)""",
)
def clip_3sigma(spark, sf):
    rows = load(spark, sf, "events", "event_id", "value")
    return D.clip_sigma(rows, "value").withColumn("value", F.round("value", 6))


@query(
    "winsorize_04",
    """SELECT o_orderkey, LEAST(o_totalprice, (SELECT quantile_disc(o_totalprice, 0.96) FROM orders)) AS o_totalprice FROM orders""",
)
def winsorize_04(spark, sf):
    return D.winsorize(load(spark, sf, "orders", "o_orderkey", "o_totalprice"), ["o_totalprice"])


_DRAW = "CAST('0x' || substr(md5('{seed}' || CAST(o_orderkey AS VARCHAR)), 1, 13) AS BIGINT)"


@query(
    "hash_split",
    f"""SELECT o_orderkey, CASE WHEN {_DRAW.format(seed=123)}::DOUBLE / 4503599627370496.0 < 0.7 THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def hash_split(spark, sf):
    return K.hash_split(load(spark, sf, "orders", "o_orderkey"), "o_orderkey", {"train": 0.7, "test": 0.3}, 123)


@query(
    "stratified_split",
    f"""SELECT o_orderkey, label, CASE WHEN rn <= ROUND(0.6 * n) THEN 'train' WHEN rn <= ROUND(0.8 * n) THEN 'valid' ELSE 'test' END AS split FROM (
    SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS label, COUNT(*) OVER (PARTITION BY o_orderstatus = 'F') AS n,
    ROW_NUMBER() OVER (PARTITION BY o_orderstatus = 'F' ORDER BY {_DRAW.format(seed=42)}) AS rn FROM orders)""",
)
def stratified_split(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return K.stratified_split(rows, "o_orderkey", "label", [0, 1], {"train": 0.6, "valid": 0.2, "test": 0.2}, 42)


@query("sample_n", f"SELECT o_orderkey FROM orders ORDER BY {_DRAW.format(seed=5)}, o_orderkey LIMIT 500")
def sample_n(spark, sf):
    return K.sample_n(load(spark, sf, "orders", "o_orderkey"), "o_orderkey", 500, 5)


@query(
    "month_seasonality",
    f"""SELECT CAST(month(o_orderdate) AS BIGINT) AS month, {mean_sql('o_totalprice')} AS mean, COUNT(*) AS size,
    ROUND(quantile_cont(o_totalprice, 0.5), 6) AS median FROM orders GROUP BY 1""",
)
def month_seasonality(spark, sf):
    return A.seasonality(load(spark, sf, "orders"), "o_orderdate", "o_totalprice").withColumn("median", F.round("median", 6))


def _period_sql(start):
    return f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) >= (SELECT {start} FROM orders)"


@query(
    "period_filter",
    " UNION ALL ".join(
        f"SELECT '{name}' AS span, COUNT(*) AS orders FROM ({_period_sql(start)})"
        for name, start in {
            "1m": "CAST(MAX(o_orderdate) AS DATE) - INTERVAL 1 MONTH", "6m": "CAST(MAX(o_orderdate) AS DATE) - INTERVAL 6 MONTH",
            "ytd": "date_trunc('year', MAX(o_orderdate))", "1y": "CAST(MAX(o_orderdate) AS DATE) - INTERVAL 12 MONTH",
            "all": "MIN(o_orderdate)",
        }.items()
    ),
)
def period_filter(spark, sf):
    days = load(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return append_rows(*[
        period(days, "day", s).agg(F.lit(s).alias("span"), F.count(F.lit(1)).alias("orders"))
        for s in ["1m", "6m", "ytd", "1y", "all"]
    ])


@query(
    "interaction",
    "SELECT p_partkey, p_size * p_retailprice AS size_price, ROUND(ln(p_retailprice), 9) AS log_price FROM part",
)
def interaction(spark, sf):
    return load(spark, sf, "part").select(
        "p_partkey", D.interact("p_size", "p_retailprice").alias("size_price"), F.round(F.ln("p_retailprice"), 9).alias("log_price")
    )


def _churn(spark, sf):
    """Customers as subscribers: churn by balance, age by nation, length of service missing for one segment."""
    c = load(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("cust_id"),
        (F.col("c_acctbal") < 0).cast("int").alias("churn"),
        F.col("c_acctbal").alias("mon_purch"),
        F.col("c_nationkey").alias("freq_purch"),
        (F.col("c_nationkey") + 20).alias("age"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.abs("c_acctbal") / 20).alias("LOS"),
        (F.col("c_acctbal") / 1000).alias("rec_complaints"),
        (F.col("c_mktsegment") == "FURNITURE").cast("int").alias("d_age_missing"),
        F.length("c_mktsegment").alias("d_gender"),
    )


@query(
    "churn_steps",
    """SELECT c_custkey AS cust_id, c_acctbal * 1.15::DOUBLE AS mon_purch_dol, c_acctbal / NULLIF(c_nationkey, 0) AS avg_mon_purch,
    DATE '2011-01-24' AS snapshot_date, CAST(c_custkey AS VARCHAR) || CAST(c_acctbal < 0 AS INTEGER) AS cust_id2,
    CAST(c_nationkey + 20 + 10 AS BIGINT) AS age2, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'regular' WHEN abs(c_acctbal) / 20 >= 100 THEN 'loyal'
    ELSE 'regular' END AS "LOS2", '24JAN2011' AS snapshot_text FROM customer""",
)
def churn_derived(spark, sf):
    """Derived columns as of ten years after the snapshot."""
    out = derived_columns(_churn(spark, sf), date(2021, 1, 24))
    return out.select("cust_id", "mon_purch_dol", "avg_mon_purch", "snapshot_date", "cust_id2", "age2", "LOS2", "snapshot_text")


@query(
    "churn_totals",
    """SELECT c_custkey AS cust_id, CAST(SUM(c_nationkey) OVER (ORDER BY c_custkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tot_freq_purch FROM customer""",
)
def churn_totals(spark, sf):
    """Running total over all customers in key order."""
    return run_churn_steps(_churn(spark, sf), date(2021, 1, 24))["total_sum"].select("cust_id", "tot_freq_purch")
