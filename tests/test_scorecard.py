"""Scorecards read their applicants as a written table and score them without matching ids again."""

import pytest
from pyspark.sql import functions as F

from abacist.operators import models as M
from abacist.operators import sampling
from abacist.plans import scorecard
from abacist.plans.scorecard import run_scorecard
from abacist.queries import credit

SF = "/root/testdata/sf0.001"


def test_applicants_are_joined_once(spark):
    rows = credit._applicants(spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert not [f for f in rows.inputFiles() if "customer" in f or "orders" in f]


def test_test_applicants_are_scored_in_place(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        rows = credit._applicants(spark, SF)
        accepted = rows.where(F.col("o_orderpriority") != "5-LOW").drop("o_orderpriority")
        rejected = rows.where(F.col("o_orderpriority") == "5-LOW").drop("o_orderpriority", "defaulted")
        card, out = run_scorecard(accepted, rejected, "o_orderkey", "defaulted", credit.APPLICANT_COLUMNS)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        found = out.toPandas()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert list(out.columns) == ["o_orderkey", "defaulted", "prob", "predicted", "score"]
    assert found["o_orderkey"].is_unique and len(found) == pytest.approx(accepted.count() * 0.2, abs=2)
    assert found["prob"].between(0, 1).all() and found["score"].notna().all()
    # points are a linear form of the margin, so both order applicants alike
    assert found["prob"].corr(found["score"], method="pearson") > 0.5


def test_a_fit_reads_each_combination_once(spark, monkeypatch):
    rows = spark.range(20_000).select(
        (F.col("id") % 5 / 10).alias("a"), (F.col("id") % 7 / 10).alias("b"), (F.hash("id") % 10 + F.col("id") % 5 > 3).cast("int").alias("y"),
    )
    whole = M.fit(M.logistic(tol=1e-12), M.features_of(rows, ["a", "b"], "y"))
    seen = []
    monkeypatch.setattr(M, "complete", lambda df, **_: seen.append(df.count()) or df)
    counted = M.fit_counted(M.logistic(tol=1e-12), rows, ["a", "b"], "y")
    assert seen == [rows.distinct().count()]
    assert [*counted.coefficients, counted.intercept] == pytest.approx([*whole.coefficients, whole.intercept], rel=1e-6)
    assert not counted.isSet(counted.weightCol)
    # a penalty would meet deviations of weighted rows: all rows are read
    M.fit_counted(M.logistic(regParam=0.1), rows, ["a", "b"], "y")
    assert seen[1] == 20_000
    plain = {(r["a"], r["b"]): r for r in M.score_columns(whole, rows, ["a", "b"], ["a", "b"]).distinct().collect()}
    vectors = M.score(whole, M.features_of(rows, ["a", "b"], keep=["a", "b"])).drop("features", "rawPrediction", "probability")
    for r in vectors.distinct().collect():
        mine = plain[(r["a"], r["b"])]
        assert mine["prob"] == pytest.approx(r["prob"], rel=1e-12) and mine["predicted"] == r["predicted"]
    missing = spark.createDataFrame([(None, 1.0), (float("nan"), 1.0)], "a double, b double")
    assert [(r["prob"], r["predicted"]) for r in M.score_columns(whole, missing, ["a", "b"], ["b"]).collect()] == [(None, None)] * 2


def test_a_scorecard_writes_applicants_once_and_fits_on_counts(spark, monkeypatch):
    written = []

    def counting(df):
        out = materialise(df)
        written.append(out.count())
        return out

    materialise = scorecard.materialise
    monkeypatch.setattr(scorecard, "materialise", counting)
    monkeypatch.setattr(sampling, "materialise", counting)
    monkeypatch.setattr(M, "fit", lambda *_: pytest.fail("a fit on all rows"))
    _, out = credit._scorecard(spark, SF)
    rows = credit._applicants(spark, SF)
    rejected = rows.where(F.col("o_orderpriority") == "5-LOW")
    assert written == [rejected.count()]  # before: draws, split, scored rejects and all rows together
    # draws made by the plan itself give the same rows
    accepted = rows.where(F.col("o_orderpriority") != "5-LOW").drop("o_orderpriority")
    _, own = run_scorecard(accepted, rejected.drop("o_orderpriority", "defaulted"), "o_orderkey", "defaulted", credit.APPLICANT_COLUMNS)
    assert own.count() == out.count() and own.select("o_orderkey").exceptAll(out.select("o_orderkey")).isEmpty()
