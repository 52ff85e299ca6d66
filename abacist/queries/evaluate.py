"""Evaluation of a fixed score on the orders: price as score, closed orders as targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from abacist.operators import evaluate as E
from abacist.operators.models import attach_scores, rank_scores
from abacist.queries.registry import load, query

SCORED_SQL = """s AS (SELECT o_orderkey, ROUND(o_totalprice / 1000) / 500 AS score, CAST(o_orderstatus = 'F' AS INTEGER) AS target FROM orders)"""


def _scored(spark, sf):
    return load(spark, sf, "orders").select(
        "o_orderkey", (F.round(F.col("o_totalprice") / 1000) / 500).alias("score"), (F.col("o_orderstatus") == "F").cast("int").alias("target")
    )


_CURVE = """c AS (SELECT score, SUM(target) AS pos, SUM(1 - target) AS neg FROM s GROUP BY 1),
  r AS (SELECT *, SUM(pos) OVER (ORDER BY score DESC)::DOUBLE AS tp, SUM(neg) OVER (ORDER BY score DESC)::DOUBLE AS fp,
    SUM(pos) OVER ()::DOUBLE AS p, SUM(neg) OVER ()::DOUBLE AS n FROM c)"""


@query(
    "auc_rank",
    f"""WITH {SCORED_SQL}, {_CURVE} SELECT ROUND(SUM(pos * ((n - fp) + neg / 2.0::DOUBLE)) / MAX(p * n), 9) AS auc_roc,
    ROUND(SUM(pos * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg > 0 THEN (tp - pos) / (tp - pos + fp - neg) ELSE tp / (tp + fp) END) / 2) / MAX(p), 9) AS auc_pr
    FROM r""",
)
def auc_rank(spark, sf):
    return E.auc(_scored(spark, sf), "score", "target").withColumns({c: F.round(c, 9) for c in ["auc_roc", "auc_pr"]})


@query("roc_points", f"WITH {SCORED_SQL}, {_CURVE} SELECT score AS threshold, fp / n AS fpr, tp / p AS tpr FROM r")
def roc_points(spark, sf):
    """Curve points, with the distinct scores forced through range-partitioned blocks."""
    return E.roc_points(_scored(spark, sf), "score", "target", group_limit=100, parts=4)


@query(
    "class_report",
    """WITH p AS (SELECT o_orderstatus AS actual, CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 200000 THEN 'O' ELSE 'P' END AS guess FROM orders),
    k AS (SELECT DISTINCT actual AS class FROM p),
    n AS (SELECT class, (SELECT COUNT(*) FROM p WHERE actual = class AND guess = class) AS hits, (SELECT COUNT(*) FROM p WHERE actual = class) AS support,
      (SELECT COUNT(*) FROM p WHERE guess = class) AS predicted FROM k)
    SELECT class, hits::DOUBLE / predicted::DOUBLE AS precision, hits::DOUBLE / support::DOUBLE AS recall,
      2.0::DOUBLE * hits / (support + predicted)::DOUBLE AS f1, support FROM n""",
)
def class_report(spark, sf):
    guess = F.when(F.col("o_totalprice") > 300000, "F").when(F.col("o_totalprice") > 200000, "O").otherwise("P")
    return E.class_report(load(spark, sf, "orders").withColumn("guess", guess), "guess", "o_orderstatus")


@query("accuracy", f"WITH {SCORED_SQL} SELECT COUNT(*) FILTER (target = CAST(score > 0.5 AS INTEGER))::DOUBLE / COUNT(*)::DOUBLE AS accuracy FROM s")
def accuracy(spark, sf):
    return E.accuracy(_scored(spark, sf).withColumn("pred", (F.col("score") > 0.5).cast("int")), "pred", "target")


_LIFT_SQL = f"""{SCORED_SQL}, q AS (SELECT quantile_cont(score, [{', '.join(str(i / 20) for i in range(1, 20))}]) AS cuts FROM s),
  b AS (SELECT CAST(20 - len(list_filter(cuts, lambda c: score > c)) AS INTEGER) AS bin, COUNT(*) AS rows, CAST(SUM(target) AS BIGINT) AS targets FROM s, q GROUP BY 1),
  c AS (SELECT *, SUM(rows) OVER (ORDER BY bin)::DOUBLE AS cr, SUM(targets) OVER (ORDER BY bin)::DOUBLE AS ct,
    SUM(rows) OVER ()::DOUBLE AS n, SUM(targets) OVER ()::DOUBLE AS t FROM b),
  l AS (SELECT bin, rows, targets, targets::DOUBLE / rows::DOUBLE AS response, (targets::DOUBLE / rows::DOUBLE) / (t / n) AS lift, cr / n AS perc_selected,
    ct / cr AS cum_response, (ct / cr) / (t / n) AS cum_lift, ct / t AS cum_gain FROM c)"""


@query("lift_table", f"WITH {_LIFT_SQL} SELECT * FROM l")
def lift_table(spark, sf):
    return E.lift_table(_scored(spark, sf), "score", "target")


@query("campaign_profit", f"WITH {_LIFT_SQL} SELECT *, 50 * cum_response * (perc_selected * 20000) - 3 * (perc_selected * 20000) AS profit FROM l")
def campaign_profit(spark, sf):
    return E.campaign_profit(E.lift_table(_scored(spark, sf), "score", "target"), 50, 3, 20000)


@query(
    "campaign_reach",
    f"""WITH {_LIFT_SQL} SELECT wanted, MIN(bin) AS bin, MIN(perc_selected) * 20000 AS rows_to_select
    FROM l, (VALUES (500), (2000)) v(wanted) WHERE cum_lift * 0.2 * perc_selected * 20000 >= wanted - 1e-6 GROUP BY 1""",
)
def campaign_reach(spark, sf):
    return E.reach(E.lift_table(_scored(spark, sf), "score", "target"), [500, 2000], 0.2, 20000)


@query("class_totals", "SELECT o_orderstatus, COUNT(*) AS rows FROM orders GROUP BY 1")
def class_totals(spark, sf):
    return E.class_totals(load(spark, sf, "orders"), "o_orderstatus")


@query("scores_attached", f"WITH {SCORED_SQL} SELECT o_custkey, o_orderkey, score FROM orders JOIN s USING (o_orderkey)")
def scores_attached(spark, sf):
    """Scores joined back to their rows by key and listed from the highest."""
    rows = attach_scores(load(spark, sf, "orders", "o_custkey", "o_orderkey"), _scored(spark, sf), "o_orderkey", ["score"])
    return rank_scores(rows, "score").select("o_custkey", "o_orderkey", "score")
