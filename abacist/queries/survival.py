"""Loans are orders: weeks from order to the end of the data, default when the order is closed."""

from __future__ import annotations

from pyspark.sql import functions as F

from abacist.operators import survival as S
from abacist.plans.survival_study import run_survival, static_loans
from abacist.queries.registry import load, query

END = "2001-08-02"

LOANS_SQL = f"""loans AS (SELECT o_orderkey AS id, CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '{END}') / 7) AS BIGINT) AS time,
    CAST(o_orderstatus = 'F' AS INTEGER) AS event, CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS grp, o_totalprice AS balance FROM orders)"""


def _loans(spark, sf):
    return load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.floor(F.datediff(F.to_date(F.lit(END)), F.to_date("o_orderdate")) / 7).alias("time"),
        (F.col("o_orderstatus") == "F").cast("int").alias("event"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("grp"),
        F.col("o_totalprice").alias("balance"),
    )


_TABLE = """SELECT time, COUNT(*) AS removed, CAST(SUM(event) AS BIGINT) AS observed, COUNT(*) - CAST(SUM(event) AS BIGINT) AS censored,
    CAST(SUM(COUNT(*)) OVER (ORDER BY time DESC) AS BIGINT) AS at_risk FROM loans GROUP BY time"""
_GROUPED = _TABLE.replace("SELECT time", "SELECT grp, time").replace("OVER (ORDER", "OVER (PARTITION BY grp ORDER").replace("GROUP BY time", "GROUP BY grp, time")


def _km(table, by=""):
    return f"SELECT *, ROUND(product(1 - observed::DOUBLE / at_risk::DOUBLE) OVER ({by} ORDER BY time), 9) AS survival FROM ({table})"


@query(
    "episodic_static",
    """SELECT o_custkey, MAX(o_totalprice) AS o_totalprice, MAX(marked) AS marked, MAX(o_orderdate) AS o_orderdate FROM
    (SELECT *, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -999 END AS marked FROM orders) GROUP BY 1""",
)
def episodic_static(spark, sf):
    episodes = load(spark, sf, "orders", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderdate").withColumn(
        "marked", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    )
    return static_loans(episodes.drop("o_orderstatus"), "o_custkey", ["marked"])


@query("event_table", f"WITH {LOANS_SQL} {_TABLE}")
def event_table(spark, sf):
    return S.event_table(_loans(spark, sf), "time", "event")


@query("kaplan_meier", f"WITH {LOANS_SQL} SELECT *, ROUND(1 - survival, 9) AS cumulative_density FROM ({_km(_TABLE)})")
def kaplan_meier(spark, sf):
    km = S.kaplan_meier(_loans(spark, sf), "time", "event").withColumn("survival", F.round("survival", 9))
    return S.cumulative_density(km).withColumn("cumulative_density", F.round("cumulative_density", 9))


@query("kaplan_meier_groups", f"WITH {LOANS_SQL} {_km(_GROUPED, 'PARTITION BY grp')}")
def kaplan_meier_groups(spark, sf):
    """Curves per group, with the event times forced through range-partitioned blocks."""
    km = S.kaplan_meier(_loans(spark, sf), "time", "event", "grp", group_limit=100, parts=6)
    return km.withColumn("survival", F.round("survival", 9))


@query(
    "survival_at",
    f"""WITH {LOANS_SQL}, q AS (SELECT quantile_cont(balance, 0.3) AS cut FROM loans),
    g AS (SELECT time, event, CAST(balance > cut AS INTEGER) AS grp FROM loans, q),
    km AS ({_km(_GROUPED.replace('FROM loans', 'FROM g'), 'PARTITION BY grp')})
    SELECT grp AS large, t AS time, survival FROM (SELECT grp, t, arg_max(survival, time) AS survival FROM km, (VALUES (25), (50)) v(t)
      WHERE time <= t GROUP BY grp, t)""",
)
def survival_at(spark, sf):
    """Survival at weeks 25 and 50, for balances above and below their 30 % quantile."""
    split = S.split_by_quantile(_loans(spark, sf), "balance", 0.3, "large")
    km = S.kaplan_meier(split, "time", "event", "large")
    return S.survival_at(km, [25, 50], "large").withColumn("survival", F.round("survival", 9))


@query("median_event", f"WITH {LOANS_SQL} SELECT quantile_cont(CAST(time AS DOUBLE), 0.5) AS median_time, COUNT(*) AS events FROM loans WHERE event = 1")
def median_event(spark, sf):
    loans = _loans(spark, sf)
    median = S.median_event_time(loans, "time", "event")
    return loans.where("event = 1").agg(F.lit(median).alias("median_time"), F.count(F.lit(1)).alias("events"))


@query(
    "logrank_stat",
    f"""WITH {LOANS_SQL}, t AS (SELECT time, SUM(COUNT(*)) OVER (ORDER BY time DESC)::DOUBLE AS r,
      SUM(SUM(grp)) OVER (ORDER BY time DESC)::DOUBLE AS r1, SUM(event)::DOUBLE AS d, SUM(event * grp)::DOUBLE AS d1 FROM loans GROUP BY time),
    s AS (SELECT SUM(d1) AS observed, SUM(d * r1 / r) AS expected,
      SUM(CASE WHEN r > 1 THEN d * (r1 / r) * (1 - r1 / r) * (r - d) / (r - 1) ELSE 0 END) AS variance FROM t)
    SELECT observed, ROUND(expected, 6) AS expected, ROUND(variance, 6) AS variance,
      ROUND((observed - expected) * (observed - expected) / variance, 6) AS test_statistic FROM s""",
)
def logrank_stat(spark, sf):
    test = S.logrank(_loans(spark, sf), "time", "event", "grp", 1)
    return test.drop("p_value").withColumns({c: F.round(c, 6) for c in ["expected", "variance", "test_statistic"]})


@query("logrank_p")
def logrank_p(spark, sf):
    return S.logrank(_loans(spark, sf), "time", "event", "grp", 1)


@query("cox_tv")
def cox_tv(spark, sf):
    """Hazard of closing by order value, priority and customer balance."""
    balance = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_acctbal") / 1000).alias("account"))
    rows = load(spark, sf, "orders").join(balance, "o_custkey").select(
        F.lit(0).alias("start"),
        (F.floor(F.datediff(F.to_date(F.lit(END)), F.to_date("o_orderdate")) / 7) + 1).alias("stop"),
        (F.col("o_orderstatus") == "F").cast("int").alias("event"),
        (F.col("o_totalprice") / 100000).alias("price"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("urgent"),
        "account",
    )
    return S.cox_tv(rows, "start", "stop", "event", ["price", "urgent", "account"])


@query(
    "survival_study",
    f"""WITH {LOANS_SQL}, km AS ({_km(_TABLE)}) SELECT t AS time, arg_max(survival, time) AS survival
    FROM km, (VALUES (25), (50)) v(t) WHERE time <= t GROUP BY t""",
)
def survival_study(spark, sf):
    """Survival at weeks 25 and 50 from the whole study."""
    study = run_survival(_loans(spark, sf), "time", "event", "grp", 1, [25, 50], "balance")
    return study["survival_at"].withColumn("survival", F.round("survival", 9))
