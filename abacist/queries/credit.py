"""Scorecards: line items with a discount-and-tax event, and orders as applicants."""

from __future__ import annotations

from pyspark.sql import functions as F

from abacist.operators import credit as C
from abacist.operators import models as M
from abacist.operators.sampling import hash_number
from abacist.plans.scorecard import run_scorecard
from abacist.queries.registry import load, query
from abacist.session import materialise

NUMERIC = ["l_discount", "l_tax", "l_quantity", "l_extendedprice", "l_linenumber"]
TEXTS = ["l_returnflag", "l_linestatus"]


def _items(spark, sf):
    """Event: discount and tax together above ten percent. The flag N is made missing."""
    return load(spark, sf, "lineitem").select(
        "l_orderkey", *NUMERIC, F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("l_returnflag"),
        "l_linestatus", (F.rint((F.col("l_discount") + F.col("l_tax")) * 100) > 10).cast("int").alias("event"),
    )


_ITEMS_SQL = """items AS (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
    CASE WHEN ROUND((l_discount + l_tax) * 100) > 10 THEN 1 ELSE 0 END AS event FROM lineitem)"""
_WOE_SQL = """b AS (SELECT var, category, COUNT(*) AS count, CAST(SUM(event) AS BIGINT) AS event FROM
    (SELECT 'l_returnflag' AS var, flag AS category, event FROM items UNION ALL SELECT 'l_linestatus', l_linestatus, event FROM items) GROUP BY 1, 2),
  s AS (SELECT *, event::DOUBLE / SUM(event) OVER (PARTITION BY var)::DOUBLE AS de,
    (count - event)::DOUBLE / SUM(count - event) OVER (PARTITION BY var)::DOUBLE AS dne FROM b),
  w AS (SELECT *, CASE WHEN de > 0 AND dne > 0 THEN ln(de / dne) ELSE 0 END AS woe FROM s)"""


@query(
    "woe_categorical",
    f"""WITH {_ITEMS_SQL}, {_WOE_SQL} SELECT var, category, count, event, count - event AS nonevent, event::DOUBLE / count::DOUBLE AS event_rate,
    (count - event)::DOUBLE / count::DOUBLE AS non_event_rate, de AS dist_event, dne AS dist_non_event, ROUND(woe, 9) AS woe,
    ROUND(SUM((de - dne) * woe) OVER (PARTITION BY var), 9) AS iv FROM w""",
)
def woe_categorical(spark, sf):
    scored = C.woe_iv(C.char_bins(_items(spark, sf), "event", TEXTS))
    return scored.drop("min_value", "max_value").withColumns({"woe": F.round("woe", 9), "iv": F.round("iv", 9)})


@query(
    "woe_transform",
    f"""WITH {_ITEMS_SQL}, {_WOE_SQL} SELECT i.l_orderkey, i.l_linenumber, i.flag AS l_returnflag, i.l_linestatus,
    ROUND(a.woe, 9) AS "new_l_returnflag", ROUND(c.woe, 9) AS "new_l_linestatus" FROM items i
    JOIN w a ON a.var = 'l_returnflag' AND a.category IS NOT DISTINCT FROM i.flag JOIN w c ON c.var = 'l_linestatus' AND c.category = i.l_linestatus""",
)
def woe_transform(spark, sf):
    items = _items(spark, sf)
    bins = C.woe_iv(C.char_bins(items, "event", TEXTS))
    out = C.woe_transform(items.select("l_orderkey", "l_linenumber", *TEXTS), bins, [], TEXTS)
    return out.withColumns({c: F.round(c, 9) for c in ["new_l_returnflag", "new_l_linestatus"]})


@query("woe_monotone")
def woe_monotone(spark, sf):
    """Monotone bins of five numeric columns over all line items."""
    return C.bins_in_order(C.woe_iv(C.mono_bins(_items(spark, sf), "event", NUMERIC)))


@query(
    "woe_monotone_totals",
    f"""WITH {_ITEMS_SQL} SELECT var, COUNT(*) AS rows, CAST(SUM(event) AS BIGINT) AS events, MIN(x) AS lowest, MAX(x) AS highest FROM (
    {' UNION ALL '.join(f"SELECT '{c}' AS var, CAST({c} AS DOUBLE) AS x, event FROM items" for c in NUMERIC)}) GROUP BY 1""",
)
def woe_monotone_totals(spark, sf):
    """What every choice of bins must preserve: rows, events and range of each column."""
    return C.mono_bins(_items(spark, sf), "event", NUMERIC).groupBy("var").agg(
        F.sum("count").alias("rows"), F.sum("event").alias("events"),
        F.min("min_value").alias("lowest"), F.max("max_value").alias("highest"),
    )


@query("iv_rank")
def iv_rank(spark, sf):
    bins = C.bin_all(_items(spark, sf), "event", [*NUMERIC, *TEXTS])
    return C.iv_table(bins).orderBy(F.desc("iv"))


def _applicants(spark, sf, *more):
    """Orders as applicants; a default is an order of much value from a customer with little balance.

    Written once: the steps of a scorecard read their applicants again and again, and each time would join them.
    """
    customer = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment", "c_nationkey")
    orders = load(spark, sf, "orders").join(customer, "o_custkey")
    risk = F.col("o_totalprice") / 1000 - F.col("c_acctbal") / 50 + F.when(F.col("o_orderstatus") == "F", 60).otherwise(0)
    return materialise(orders.select(
        "o_orderkey", "o_totalprice", F.month("o_orderdate").alias("month"), "c_acctbal", "c_nationkey", "o_orderstatus", "c_mktsegment",
        "o_orderpriority", (risk > 200).cast("int").alias("defaulted"), *more,
    ))


APPLICANT_COLUMNS = ["o_totalprice", "month", "c_acctbal", "c_nationkey", "o_orderstatus", "c_mktsegment"]


def _scorecard(spark, sf):
    rows = _applicants(spark, sf, hash_number("o_orderkey", 42).alias("draw"))
    accepted = rows.where(F.col("o_orderpriority") != "5-LOW").drop("o_orderpriority")
    rejected = rows.where(F.col("o_orderpriority") == "5-LOW").drop("o_orderpriority", "defaulted", "draw")
    return run_scorecard(accepted, rejected, "o_orderkey", "defaulted", APPLICANT_COLUMNS, draw="draw")


@query("scorecard_points")
def scorecard_points(spark, sf):
    """Points per bin after reject inference and refit."""
    return _scorecard(spark, sf)[0].card


@query("scorecard_applicants")
def scorecard_applicants(spark, sf):
    """Probability and total points of the test applicants."""
    return _scorecard(spark, sf)[1]


@query(
    "reject_label",
    """WITH s AS (SELECT o_orderkey, o_totalprice / 500000 AS prob_default FROM orders), q AS (SELECT quantile_cont(prob_default, 0.2) AS cut FROM s),
    p AS (SELECT quantile_cont(v, 0.2) AS cut FROM (SELECT prob_default AS v FROM s UNION ALL SELECT 1.0::DOUBLE - prob_default FROM s))
    SELECT o_orderkey, CAST(prob_default > q.cut AS INTEGER) AS label, CAST(prob_default > p.cut AS INTEGER) AS pooled FROM s, q, p""",
)
def reject_label(spark, sf):
    scored = load(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000).alias("prob_default"))
    own = C.infer_rejects(scored)
    return C.infer_rejects(own, label="pooled", pooled=True).select("o_orderkey", "label", "pooled")


@query(
    "scorecard_formula",
    f"""WITH {_ITEMS_SQL}, {_WOE_SQL} SELECT var, category,
    ROUND((woe * 0.7 + -1.2 / 16) * (20 / ln(2)) + (600 - (20 / ln(2)) * ln(50)) / 16, 6) AS points FROM w""",
)
def scorecard_formula(spark, sf):
    bins = C.woe_iv(C.char_bins(_items(spark, sf), "event", TEXTS))
    coefs = spark.createDataFrame([(t, 0.7) for t in TEXTS], "var string, coef double")
    card = C.scorecard(bins, coefs, alpha=-1.2, n=16)
    return card.select("var", "category", F.round("points", 6).alias("points"))


@query("refit_rejects")
def refit_rejects(spark, sf):
    """Coefficients after binning accepted rows and labelled rejects together."""
    rows = _applicants(spark, sf)
    accepted = rows.where(F.col("o_orderpriority") != "5-LOW")
    rejected = C.infer_rejects(
        rows.where(F.col("o_orderpriority") == "5-LOW").withColumn("prob_default", F.col("o_totalprice") / 500000),
        label="defaulted",
    )
    mono, chars = C.split_kinds(rows, APPLICANT_COLUMNS)
    names = ["new_" + x for x in [*mono, *chars]]
    _, model = C.refit_with_rejects(
        [accepted], rejected, "defaulted", APPLICANT_COLUMNS,
        lambda woe: M.fit_counted(M.logistic(), woe, names, "defaulted"),
    )
    return M.coefficients(model, names, spark)
