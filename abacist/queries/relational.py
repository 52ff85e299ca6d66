"""Predicates, joins, set operations, grouped tables and the report shapes built from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from abacist.functions.scalars import (
    age_brought_forward, age_in_years, calendar_years, compact_date, date_of, exact_sum, first_int,
    round_all, text_match, units,
)
from abacist.operators import aggregates as A
from abacist.operators import ordered as W
from abacist.operators import prep as D
from abacist.operators import relational as P
from abacist.plans import city_reports
from abacist.queries.registry import load, mean_sql, query, sum_sql
from abacist.sources.tables import append_rows, run_sql


@query(
    "having_any",
    """SELECT o_orderpriority, COUNT(*) AS orders, CAST(SUM(o_custkey) AS BIGINT) AS customers FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1
    HAVING COUNT(*) < ANY (SELECT COUNT(*) FROM orders WHERE o_totalprice > 250000 GROUP BY o_orderpriority)""",
)
def having_any(spark, sf):
    orders = load(spark, sf, "orders")
    closed = orders.where(F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("o_custkey").alias("customers")
    )
    large = orders.where(F.col("o_totalprice") > 250000).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return P.less_than_any(closed, "orders", large, "n")


@query(
    "exists_semi",
    """SELECT c_nationkey, COUNT(*) AS customers FROM customer c WHERE EXISTS (
    SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority LIKE '%URGENT%') GROUP BY 1""",
)
def exists_semi(spark, sf):
    urgent = load(spark, sf, "orders").where(text_match("o_orderpriority", "URGENT")).select("o_custkey")
    return P.semi(load(spark, sf, "customer"), urgent, {"c_custkey": "o_custkey"}).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers")
    )


@query(
    "in_semi",
    """SELECT l_returnflag, COUNT(*) AS items, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem
    WHERE l_partkey IN (SELECT p_partkey FROM part WHERE contains(p_name, 'red')) GROUP BY 1""",
)
def in_semi(spark, sf):
    red = load(spark, sf, "part").where(text_match("p_name", "red")).select("p_partkey")
    return P.semi(load(spark, sf, "lineitem"), red, {"l_partkey": "p_partkey"}).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("items"), F.sum("l_quantity").cast("long").alias("quantity")
    )


@query(
    "drop_keys",
    """SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def drop_keys(spark, sf):
    orders = load(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    urgent = orders.select(F.col("o_custkey").alias("c_custkey"))
    return P.drop_keys(load(spark, sf, "customer", "c_custkey", "c_mktsegment"), urgent, "c_custkey")


@query(
    "intersect_keys",
    """SELECT l_orderkey AS orderkey, l_suppkey AS suppkey, l_returnflag AS flag FROM lineitem WHERE l_quantity > 25
    INTERSECT SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem WHERE l_discount < 0.05""",
)
def intersect_keys(spark, sf):
    items = load(spark, sf, "lineitem")
    cols = [F.col("l_orderkey").alias("orderkey"), F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("flag")]
    return items.where(F.col("l_quantity") > 25).select(*cols).intersect(
        items.where(F.col("l_discount") < 0.05).select(*cols)
    )


@query(
    "remerge_sum",
    """SELECT DISTINCT p_name, p_type, CAST(SUM(p_size) OVER (PARTITION BY p_name) AS BIGINT) AS size_sum FROM part""",
)
def remerge_sum(spark, sf):
    return A.remerge_sum(load(spark, sf, "part"), "p_name", ["p_type"], "p_size", "size_sum")


@query(
    "group_total_parts",
    f"""SELECT event_type, {sum_sql('value / 7')} AS total FROM events WHERE value > 1 GROUP BY 1""",
)
def group_total_parts(spark, sf):
    """Totals of numbers with more places than money has."""
    events = load(spark, sf, "events").withColumn("part", F.col("value") / 7)
    return A.group_total(events, "event_type", "part", F.col("value") > 1, "total")


@query(
    "value_join",
    """WITH a AS (SELECT c_nationkey AS nation, COUNT(*) AS n FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS nation, COUNT(*) AS m FROM supplier GROUP BY 1)
    SELECT a.nation, n, m FROM a JOIN (SELECT n AS n2, m FROM a JOIN b USING (nation)) c ON a.n = c.n2""",
)
def value_join(spark, sf):
    a = load(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("n"))
    b = load(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("m"))
    return P.join_on_value(a, a.join(b, "nation").select("n", "m"), "n").select("nation", "n", "m")


@query(
    "fanout_avg",
    f"""SELECT c_mktsegment, {mean_sql('c_acctbal')} AS mean_balance
    FROM customer JOIN supplier ON s_nationkey = c_nationkey WHERE s_acctbal > 2000 GROUP BY 1""",
)
def fanout_avg(spark, sf):
    suppliers = load(spark, sf, "supplier").where(F.col("s_acctbal") > 2000).withColumnRenamed("s_nationkey", "nation")
    customers = load(spark, sf, "customer").withColumnRenamed("c_nationkey", "nation")
    return P.fanout_mean(suppliers, customers, "nation", "c_mktsegment", "c_acctbal", "mean_balance")


@query(
    "comma_join",
    """SELECT o_orderpriority, CAST(SUM(l_quantity) AS BIGINT) AS quantity FROM lineitem, orders
    WHERE l_orderkey = o_orderkey AND CAST(l_shipdate AS DATE) = CAST(o_orderdate AS DATE) GROUP BY 1""",
)
def comma_join(spark, sf):
    items = load(spark, sf, "lineitem", "l_orderkey", "l_shipdate", "l_quantity").select(
        F.col("l_orderkey").alias("orderkey"), F.to_date("l_shipdate").alias("day"), "l_quantity"
    )
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_orderpriority").select(
        F.col("o_orderkey").alias("orderkey"), F.to_date("o_orderdate").alias("day"), "o_orderpriority"
    )
    return items.join(orders, ["orderkey", "day"]).groupBy("o_orderpriority").agg(
        F.sum("l_quantity").cast("long").alias("quantity")
    )


@query(
    "star_left",
    """SELECT c_custkey, n_orders, n_urgent, last_order FROM customer
    LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1) a ON a.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) b
      ON b.o_custkey = c_custkey
    LEFT JOIN (SELECT o_custkey, CAST(MAX(o_orderdate) AS DATE) AS last_order FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) d
      ON d.o_custkey = c_custkey""",
)
def star_left(spark, sf):
    orders = load(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return P.star_left(
        load(spark, sf, "customer", "c_custkey"),
        [
            orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_orders")),
            orders.where(F.col("o_orderpriority") == "1-URGENT").groupBy("c_custkey").agg(F.count(F.lit(1)).alias("n_urgent")),
            orders.where(F.col("o_orderstatus") == "F").groupBy("c_custkey").agg(F.to_date(F.max("o_orderdate")).alias("last_order")),
        ],
        "c_custkey",
    )


@query(
    "target_flag",
    """SELECT c_custkey, CAST(CASE WHEN c_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 1 ELSE 0 END AS INTEGER) AS target
    FROM customer""",
)
def target_flag(spark, sf):
    urgent = load(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return P.flag_member(load(spark, sf, "customer", "c_custkey"), urgent, "c_custkey", "target")


@query(
    "derived_tables",
    f"""WITH big AS (SELECT l_orderkey, {sum_sql('l_extendedprice')} AS total FROM lineitem GROUP BY 1)
    SELECT o_orderpriority, COUNT(*) AS orders, MAX(total) AS largest FROM
    (SELECT o_orderpriority, total FROM big JOIN orders ON o_orderkey = l_orderkey WHERE total > 100000) GROUP BY 1""",
)
def derived_tables(spark, sf):
    """SQL text over named frames, with a value passed as parameter."""
    return run_sql(
        spark,
        """WITH big AS (
             SELECT l_orderkey, CAST(SUM(CAST(RINT(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100.0D AS total
             FROM items GROUP BY 1)
           SELECT o_orderpriority, COUNT(*) AS orders, MAX(total) AS largest FROM
             (SELECT o_orderpriority, total FROM big JOIN ord ON o_orderkey = l_orderkey WHERE total > :least)
           GROUP BY 1""",
        {"items": load(spark, sf, "lineitem"), "ord": load(spark, sf, "orders")},
        least=100000,
    )


@query(
    "append_rows",
    """SELECT 'customer' AS kind, c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT 'supplier', s_nationkey, s_acctbal FROM supplier""",
)
def append_both(spark, sf):
    kind = lambda k, p: load(spark, sf, k).select(
        F.lit(k).alias("kind"), F.col(p + "_nationkey").alias("nation"), F.col(p + "_acctbal").alias("balance")
    )
    return append_rows(kind("customer", "c"), kind("supplier", "s"))


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return load(spark, sf, "lineitem", "l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query(
    "column_shapes",
    """SELECT c_custkey, c_name AS c_name, c_nationkey AS src_c_nationkey, 'retail' AS src_book FROM customer""",
)
def column_shapes(spark, sf):
    """Positional slice, literal column, prefix, and keeping columns by text in the name."""
    three = P.take_columns(load(spark, sf, "customer"), 3).withColumn("book", F.lit("retail"))
    prefixed = P.prefix_columns(three, "src_", keep=["c_custkey", "c_name"])
    return P.columns_like(prefixed, "src_", keep=["c_custkey", "c_name"])


@query(
    "running_total_skip",
    """SELECT o_custkey, o_orderkey, CAST(COALESCE(SUM(CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE CAST(ROUND(o_totalprice * 100) AS BIGINT) END)
      OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS total FROM orders""",
)
def running_total_skip(spark, sf):
    return _running(spark, sf, "skip")


@query(
    "running_total_propagate",
    """SELECT o_custkey, o_orderkey, CASE WHEN MAX(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) OVER w = 0 THEN
      CAST(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) OVER w AS BIGINT) END AS total
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)""",
)
def running_total_propagate(spark, sf):
    return _running(spark, sf, "propagate")


def _running(spark, sf, nulls):
    cents = F.when(F.col("o_orderpriority") != "3-MEDIUM", units("o_totalprice", 2))
    orders = load(spark, sf, "orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority").withColumn("cents", cents)
    return W.running_total(orders, ["o_custkey"], ["o_orderkey"], "cents", "total", nulls).select(
        "o_custkey", "o_orderkey", "total"
    )


@query(
    "running_total_one_group",
    """SELECT l_linestatus, l_orderkey, items, CAST(SUM(items) OVER (PARTITION BY l_linestatus ORDER BY l_orderkey
      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
    FROM (SELECT l_linestatus, l_orderkey, COUNT(*) AS items FROM lineitem GROUP BY 1, 2)""",
)
def running_total_one_group(spark, sf):
    """Two very large groups: forced through range-partitioned blocks."""
    per_order = load(spark, sf, "lineitem").groupBy("l_linestatus", "l_orderkey").agg(F.count(F.lit(1)).alias("items"))
    return W.running_total(per_order, ["l_linestatus"], ["l_orderkey"], "items", "total", group_limit=1000, parts=8)


@query(
    "split_first",
    """SELECT o_orderpriority, CASE WHEN ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) <= 400
      THEN 'train' ELSE 'test' END AS part, o_orderkey FROM orders""",
)
def split_first(spark, sf):
    orders = load(spark, sf, "orders", "o_orderpriority", "o_orderdate", "o_orderkey")
    return W.split_first(orders, ["o_orderpriority"], ["o_orderdate", "o_orderkey"], 400).drop("o_orderdate")


@query(
    "means_long",
    f"""WITH s AS (SELECT c_mktsegment, CAST(COUNT(c_acctbal) AS DOUBLE) AS n, MIN(c_acctbal) AS lo, MAX(c_acctbal) AS hi,
      {mean_sql('c_acctbal')} AS m, ROUND(STDDEV_SAMP(c_acctbal), 6) AS sd FROM customer GROUP BY 1)
    SELECT c_mktsegment, 'N' AS stat, n AS c_acctbal FROM s UNION ALL SELECT c_mktsegment, 'MIN', lo FROM s
    UNION ALL SELECT c_mktsegment, 'MAX', hi FROM s UNION ALL SELECT c_mktsegment, 'MEAN', m FROM s
    UNION ALL SELECT c_mktsegment, 'STD', sd FROM s""",
)
def means_long(spark, sf):
    long = A.means_long(load(spark, sf, "customer"), "c_mktsegment", "c_acctbal")
    return long.withColumn(
        "c_acctbal", F.when(F.col("stat") == "STD", F.round("c_acctbal", 6)).otherwise(F.col("c_acctbal"))
    )


@query(
    "freq_table",
    """WITH c AS (SELECT o_orderstatus, o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1, 2)
    SELECT o_orderstatus, o_orderpriority, count, count * 100.0::DOUBLE / SUM(count) OVER ()::DOUBLE AS percent,
      count * 100.0::DOUBLE / SUM(count) OVER (PARTITION BY o_orderstatus)::DOUBLE AS row_percent,
      count * 100.0::DOUBLE / SUM(count) OVER (PARTITION BY o_orderpriority)::DOUBLE AS col_percent FROM c""",
)
def freq_table(spark, sf):
    return A.freq_table(load(spark, sf, "orders"), "o_orderstatus", "o_orderpriority")


@query(
    "group_total",
    f"""SELECT c_mktsegment, {sum_sql('c_acctbal')} AS balance FROM customer
    WHERE c_nationkey < 13 AND c_acctbal > 310 GROUP BY 1""",
)
def group_total(spark, sf):
    cond = (F.col("c_nationkey") < 13) & (F.col("c_acctbal") > 310)
    return A.group_total(load(spark, sf, "customer"), "c_mktsegment", "c_acctbal", cond, "balance")


@query(
    "sorted_filter",
    """SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'
    ORDER BY c_acctbal DESC, c_nationkey""",
)
def sorted_filter(spark, sf):
    rows = load(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return P.order(rows, ("c_acctbal", True), ("c_nationkey", False)).select("c_custkey", "c_nationkey", "c_acctbal")


@query(
    "age_update",
    """SELECT o_orderkey, ROUND(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-03-15') / 365.0::DOUBLE, 1) AS age,
      CAST(year(DATE '2002-03-15') - year(o_orderdate) AS INTEGER) AS years,
      CAST(20 + day(o_orderdate) + 7 AS BIGINT) AS age2 FROM orders""",
)
def age_update(spark, sf):
    """Ages by days, by calendar year, and moved forward by the seven whole years from 1995-01-24."""
    as_of = F.lit(date(2002, 3, 15))
    orders = load(spark, sf, "orders", "o_orderkey", "o_orderdate").withColumn("day", F.to_date("o_orderdate"))
    return orders.select(
        "o_orderkey",
        age_in_years("day", as_of).alias("age"),
        calendar_years("day", as_of).alias("years"),
        age_brought_forward(20 + F.dayofmonth("day"), date_of(1995, 1, 24), as_of).alias("age2"),
    )


@query(
    "relabel",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'regular' WHEN c_acctbal >= 5000 THEN 'loyal' ELSE 'regular' END AS kind
    FROM customer""",
)
def relabel(spark, sf):
    rows = load(spark, sf, "customer").withColumn("los", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_acctbal")))
    return rows.select("c_custkey", D.relabel("los", 5000, "loyal", "regular").alias("kind"))


@query(
    "round_many",
    "SELECT p_partkey, ROUND(p_retailprice) AS p_retailprice, ROUND(p_size / 4.0::DOUBLE) AS quarter FROM part",
)
def round_many(spark, sf):
    parts = load(spark, sf, "part").withColumn("quarter", F.col("p_size") / F.lit(4.0))
    return parts.withColumns(round_all(["p_retailprice", "quarter"])).select("p_partkey", "p_retailprice", "quarter")


@query(
    "text_parts",
    """SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) || CAST(s_nationkey AS VARCHAR) AS id2, UPPER(s_name) AS upper_name,
      string_split(s_name, '#')[1] AS head, CAST(regexp_extract(s_name, '[0-9]+') AS BIGINT) AS number,
      UPPER(strftime(DATE '2011-01-24', '%d%b%Y')) AS snapshot FROM supplier""",
)
def text_parts(spark, sf):
    return load(spark, sf, "supplier").select(
        "s_suppkey",
        F.concat(F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")).alias("id2"),
        F.upper("s_name").alias("upper_name"),
        F.split("s_name", "#")[0].alias("head"),
        first_int("s_name").alias("number"),
        compact_date(date_of(2011, 1, 24)).alias("snapshot"),
    )


@query(
    "null_profile",
    """WITH e AS (SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value,
      CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type FROM events)
    SELECT 'event_id' AS "column", COUNT(*) - COUNT(event_id) AS missing FROM e
    UNION ALL SELECT 'value', COUNT(*) - COUNT(value) FROM e
    UNION ALL SELECT 'event_type', COUNT(*) - COUNT(event_type) FROM e""",
)
def null_profile(spark, sf):
    return A.null_profile(_holed_events(spark, sf))


def _holed_events(spark, sf):
    return load(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") != "click", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
    )


@query(
    "unique_profile",
    """SELECT 'o_custkey' AS "column", COUNT(DISTINCT o_custkey) AS unique_values FROM orders
    UNION ALL SELECT 'o_orderstatus', COUNT(DISTINCT o_orderstatus) FROM orders
    UNION ALL SELECT 'o_orderpriority', COUNT(DISTINCT o_orderpriority) FROM orders
    UNION ALL SELECT 'o_totalprice', COUNT(DISTINCT o_totalprice) FROM orders""",
)
def unique_profile(spark, sf):
    return A.unique_profile(load(spark, sf, "orders", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice"))


def _describe_sql(col, table):
    return f"""SELECT '{col}' AS "column", COUNT({col}) AS count, {mean_sql(col)} AS mean, ROUND(STDDEV_SAMP({col}), 6) AS std,
    CAST(MIN({col}) AS DOUBLE) AS min, ROUND(quantile_cont(CAST({col} AS DOUBLE), 0.25), 6) AS q25,
    ROUND(quantile_cont(CAST({col} AS DOUBLE), 0.5), 6) AS median, ROUND(quantile_cont(CAST({col} AS DOUBLE), 0.75), 6) AS q75,
    CAST(MAX({col}) AS DOUBLE) AS max FROM {table}"""


@query(
    "describe_profile",
    _describe_sql("l_quantity", "lineitem") + " UNION ALL " + _describe_sql("l_extendedprice", "lineitem"),
)
def describe_profile(spark, sf):
    return A.describe_profile(load(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]).withColumns(
        {c: F.round(c, 6) for c in ["std", "q25", "median", "q75"]}
    )


@query("shape", "SELECT COUNT(*) AS rows, CAST(11 AS BIGINT) AS columns FROM lineitem")
def shape(spark, sf):
    return A.shape(load(spark, sf, "lineitem"))


@query(
    "value_shares",
    """SELECT o_orderstatus, COUNT(*) AS count, COUNT(*)::DOUBLE / (SELECT COUNT(*) FROM orders)::DOUBLE AS share
    FROM orders GROUP BY 1""",
)
def value_shares(spark, sf):
    return A.value_shares(load(spark, sf, "orders"), "o_orderstatus")


@query(
    "bundle",
    f"""SELECT o_custkey, MAX(o_totalprice) AS max, MIN(o_totalprice) AS min, {mean_sql('o_totalprice')} AS mean,
    {sum_sql('o_totalprice')} AS sum, COUNT(o_totalprice) AS count FROM orders GROUP BY 1""",
)
def bundle(spark, sf):
    return load(spark, sf, "orders").groupBy("o_custkey").agg(*A.bundle("o_totalprice"))


@query(
    "latest",
    """SELECT user_id, MAX(ts) AS last_seen, MAX(CASE WHEN event_type = 'purchase' THEN ts END) AS last_purchase
    FROM events GROUP BY 1""",
)
def latest(spark, sf):
    return load(spark, sf, "events").groupBy("user_id").agg(
        F.max("ts").alias("last_seen"),
        F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("last_purchase"),
    )


# --- city reports on the test tables: accidents=orders, deaths=customers, places=suppliers, parts=names ---

def _accidents(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.month("o_orderdate").cast("long").alias("Month"),
        F.col("o_orderpriority").alias("Weekday"),
        F.col("o_orderstatus").alias("Part_of_the_day"),
        F.length("o_orderpriority").alias("Victims"),
        F.floor(F.col("o_totalprice") / 150000).alias("Serious_Injuries"),
        F.floor(F.col("o_totalprice") / 200000).alias("Mild_Injuries"),
        F.floor(F.col("o_totalprice") / 100000).alias("Vehicles_involved"),
        F.dayofmonth("o_orderdate").alias("District_Name"),
    )


@query("report_per_month", "SELECT CAST(month(o_orderdate) AS BIGINT) AS \"Month\", COUNT(*) AS accidents FROM orders GROUP BY 1 ORDER BY 2 DESC")
def report_per_month(spark, sf):
    return city_reports.accidents_per_month(_accidents(spark, sf))


@query("report_per_weekday", "SELECT o_orderpriority AS \"Weekday\", COUNT(*) AS accidents FROM orders GROUP BY 1 ORDER BY 2 DESC")
def report_per_weekday(spark, sf):
    return city_reports.accidents_per_weekday(_accidents(spark, sf))


@query(
    "report_part_of_day",
    """SELECT o_orderstatus AS "Part_of_the_day", COUNT(*) AS accidents, CAST(SUM(length(o_orderpriority)) AS BIGINT) AS victims FROM orders
    WHERE floor(o_totalprice / 150000) > 0 GROUP BY 1
    HAVING COUNT(*) < ANY (SELECT COUNT(*) FROM orders WHERE floor(o_totalprice / 200000) > 0)""",
)
def report_part_of_day(spark, sf):
    return city_reports.serious_by_part_of_day(_accidents(spark, sf))


@query(
    "report_mean_deaths",
    f"""SELECT d.c_mktsegment AS "Age", {mean_sql('d.c_acctbal')} AS mean_deaths
    FROM customer d JOIN orders a ON day(a.o_orderdate) = d.c_nationkey WHERE floor(a.o_totalprice / 100000) > 2 GROUP BY 1 ORDER BY 2 DESC""",
)
def report_mean_deaths(spark, sf):
    deaths = load(spark, sf, "customer").select(
        F.col("c_nationkey").alias("District_Name"), F.col("c_mktsegment").alias("Age"), F.col("c_acctbal").alias("Number")
    )
    return city_reports.mean_deaths_by_age(deaths, _accidents(spark, sf))


@query(
    "report_births",
    """SELECT c_mktsegment AS gender, CAST(SUM(c_custkey) AS BIGINT) AS number FROM customer, supplier
    WHERE c_nationkey = s_nationkey AND floor(c_acctbal / 4000) = floor(s_acctbal / 4000) GROUP BY 1 ORDER BY 2 DESC""",
)
def report_births(spark, sf):
    births = load(spark, sf, "customer").select(
        F.col("c_nationkey").alias("district_name"), F.floor(F.col("c_acctbal") / 4000).alias("neighborhood_name"),
        F.col("c_mktsegment").alias("gender"), F.col("c_custkey").alias("Number"),
    )
    stations = load(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("district_name"), F.floor(F.col("s_acctbal") / 4000).alias("neighborhood_name")
    )
    return city_reports.births_at_stations(births, stations)


@query(
    "report_immigrants_deaths",
    """WITH i AS (SELECT l_suppkey AS "District_Name", CAST(SUM(l_quantity) AS BIGINT) AS immigrants FROM lineitem WHERE l_quantity > 10 GROUP BY 1),
    d AS (SELECT l_suppkey AS "District_Name", CAST(SUM(l_linenumber) AS BIGINT) AS deaths FROM lineitem WHERE l_linenumber > 3 GROUP BY 1)
    SELECT a."District_Name", a.immigrants, b.deaths FROM i a
    JOIN (SELECT i.immigrants, d.deaths FROM i JOIN d USING ("District_Name")) b ON a.immigrants = b.immigrants""",
)
def report_immigrants_deaths(spark, sf):
    items = load(spark, sf, "lineitem")
    return city_reports.districts_with_immigrants_and_deaths(
        items.select(F.col("l_suppkey").alias("District_Name"), F.col("l_quantity").cast("long").alias("Number")),
        items.select(F.col("l_suppkey").alias("District_Name"), F.col("l_linenumber").alias("Number")),
        immigrants_over=10, deaths_over=3,
    )


@query("report_unemployment", "SELECT c_mktsegment AS \"Gender\", CAST(SUM(c_custkey) AS BIGINT) AS count FROM customer GROUP BY 1")
def report_unemployment(spark, sf):
    return city_reports.unemployment_by_gender(
        load(spark, sf, "customer").select(F.col("c_mktsegment").alias("Gender"), F.col("c_custkey").alias("Number"))
    )


@query(
    "report_names",
    """SELECT DISTINCT p_name AS "Name", p_type AS "Gender", CAST(SUM(p_size) OVER (PARTITION BY p_name) AS BIGINT) AS frequency_sum
    FROM part WHERE p_name IN (SELECT p_name FROM part WHERE contains(p_brand, '#2')) ORDER BY 3 DESC""",
)
def report_names(spark, sf):
    parts = load(spark, sf, "part")
    babies = parts.select(F.col("p_name").alias("Name"), F.col("p_type").alias("Gender"), F.col("p_size").alias("Frequency"))
    decade = F.when(F.col("p_brand").contains("#2"), "Before 1930").otherwise("Later")
    return city_reports.names_before_1930(babies, parts.select(F.col("p_name").alias("Name"), decade.alias("Decade")))


@query(
    "report_underground",
    """SELECT c_nationkey AS "District_Name", COUNT(c_name) AS neighbourhoods FROM customer
    WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > 5000) GROUP BY 1""",
)
def report_underground(spark, sf):
    people = load(spark, sf, "customer").select(F.col("c_nationkey").alias("District_Name"), F.col("c_name").alias("Neighborhood_Name"))
    transports = load(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("District_Name"),
        F.when(F.col("s_acctbal") > 5000, "Underground line").otherwise("Bus").alias("Transport"),
    )
    return city_reports.neighbourhoods_with_underground(people, transports)


@query("report_transport", "SELECT l_returnflag AS \"Transport\", COUNT(*) AS count FROM lineitem GROUP BY 1 ORDER BY 2")
def report_transport(spark, sf):
    return city_reports.transport_counts(load(spark, sf, "lineitem").select(F.col("l_returnflag").alias("Transport")))


@query(
    "report_air_stations",
    """SELECT s_name AS "Station", s_nationkey AS "Longitude", s_acctbal AS "Latitude" FROM supplier WHERE s_acctbal > 1000
    INTERSECT SELECT s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey < 15""",
)
def report_air_stations(spark, sf):
    station = load(spark, sf, "supplier").select(
        F.col("s_name").alias("Station"), F.col("s_nationkey").alias("Longitude"), F.col("s_acctbal").alias("Latitude")
    )
    return city_reports.stations_with_air_quality(station.where("Latitude > 1000"), station.where("Longitude < 15"))


@query(
    "sum_extremes",
    """WITH parts AS (
      SELECT l_returnflag, l_linenumber, SUM(l_orderkey) AS s, COUNT(CASE WHEN l_linenumber < 7 THEN 1 END) AS rows,
        bool_or(l_orderkey % 50 = 0) AS up, bool_or(l_orderkey % 50 = 1) AS down FROM lineitem GROUP BY ALL),
    marked AS (
      SELECT *, CASE WHEN l_linenumber = 4 AND up OR l_linenumber = 6 AND up AND down THEN 'NaN'
        WHEN l_linenumber IN (5, 6) AND up THEN 'Infinity' WHEN l_linenumber = 6 AND down THEN '-Infinity' END AS odd FROM parts)
    SELECT l_returnflag, l_linenumber, odd, rows, CASE WHEN odd IS NULL AND l_linenumber < 7 THEN
      CAST(CASE l_linenumber WHEN 2 THEN s || 'e-19' WHEN 3 THEN 2 * s || 'e20' ELSE CAST(s AS VARCHAR) END AS DOUBLE) END AS total
    FROM marked""",
)
def sum_extremes(spark, sf):
    """Sums of very small and large numbers, and with NaN and infinite ones among them, by line number."""
    key, kind = F.col("l_orderkey"), F.col("l_linenumber")
    marks = [key % 50 == 0, key % 50 == 1]
    digits = F.when(kind == 2, F.concat(key, F.lit("e-19"))).when(kind == 3, F.concat(2 * key, F.lit("e20")))
    digits = digits.when((kind == 4) & marks[0], "NaN").when(kind.isin(5, 6) & marks[0], "Infinity")
    digits = digits.when((kind == 6) & marks[1], "-Infinity").when(kind < 7, key.cast("string"))
    rows = load(spark, sf, "lineitem").select("l_returnflag", "l_linenumber", digits.cast("double").alias("x"))
    sums = rows.groupBy("l_returnflag", "l_linenumber").agg(exact_sum("x").alias("s"), F.count("x").alias("rows"))
    finite = F.abs("s") < float("inf")
    return sums.select("l_returnflag", "l_linenumber", F.when(~finite, F.col("s").cast("string")).alias("odd"),
                       F.when(finite, F.col("s")).alias("total"), "rows")
