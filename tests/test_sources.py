import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abacist.plans import ad_report, supplier_view, web_report, web_warehouse
from abacist.sources import files, tables
from abacist.sources.reload import reload_window

SCHEMA = T.StructType([
    T.StructField("v", T.LongType()), T.StructField("date", T.DateType()), T.StructField("country", T.StringType()),
])


def test_reload_window(spark, frame, tmp_path):
    days = [date(2024, 3, d) for d in (1, 2, 3, 4)]
    old = frame([(1, d, c) for d in days for c in ("de", "fr")], SCHEMA)
    tables.ensure_table(spark, "rl", SCHEMA, ["date", "country"], str(tmp_path / "rl"))
    tables.append(old, "rl")
    # the third day has no new rows and must end empty
    new = frame([(2, d, "de") for d in (days[1], days[3])], SCHEMA)
    for _ in range(2):
        reload_window(new, "rl", "date", days[3], 2)
        got = {(r["date"].day, r["country"], r["v"]) for r in spark.table("rl").collect()}
        assert got == {(1, "de", 1), (1, "fr", 1), (2, "de", 2), (4, "de", 2)}


def test_reload_window_with_null_and_escaped_partitions(spark, frame, tmp_path):
    days = [date(2024, 3, d) for d in (1, 2, 3)]
    names = [None, "a/b", "it's", "x=y", "de"]
    tables.ensure_table(spark, "rl_odd", SCHEMA, ["date", "country"], str(tmp_path / "rl_odd"))
    tables.append(frame([(1, d, c) for d in days for c in names], SCHEMA), "rl_odd")
    new = frame([(2, days[1], None), (2, days[1], "a/b"), (2, days[2], "it's")], SCHEMA)
    expected = {(1, c, 1) for c in names} | {(2, None, 2), (2, "a/b", 2), (3, "it's", 2)}
    for _ in range(2):
        reload_window(new, "rl_odd", "date", days[2], 1)
        rows = spark.table("rl_odd").collect()
        assert len(rows) == len(expected) and {(r["date"].day, r["country"], r["v"]) for r in rows} == expected


def test_reload_window_of_one_country(spark, frame, tmp_path):
    days = [date(2024, 3, d) for d in (1, 2, 3)]
    tables.ensure_table(spark, "rc", SCHEMA, ["date", "country"], str(tmp_path / "rc"))
    tables.append(frame([(1, d, c) for d in days for c in ("de", "fr")], SCHEMA), "rc")
    reload_window(frame([(5, days[2], "fr"), (9, days[2], "de")], SCHEMA), "rc", "date", days[2], 1, among={"country": ["fr"]})
    got = {(r["date"].day, r["country"], r["v"]) for r in spark.table("rc").collect()}
    assert got == {(1, "de", 1), (1, "fr", 1), (2, "de", 1), (3, "de", 1), (3, "fr", 5)}


def test_staging_to_warehouse(spark, frame, tmp_path):
    schema = "date date, trackingcode string, bounces long, pageviews long, uniquevisitors long, visits long, cm1006_1 long, cm1006_21 long"
    day, before = date(2024, 5, 2), date(2024, 5, 1)
    for iso, code in (("de", "ban_1"), ("fr", "banX1")):
        frame([(day, code, 1, 2, 3, 4, 5, 6), (before, code, 1, 1, 1, 1, 1, 1), (before, code, 1, 1, 1, 1, 1, 1)], schema
              ).createOrReplaceTempView(f"source_{iso}_web")
    web_warehouse.run_staging(spark, "source_{tag}_web", ["de", "fr"], "stg", day, path=str(tmp_path / "stg"))
    assert spark.table("stg").count() == 4  # repeated rows are staged once
    web_warehouse.run_warehouse(spark, "stg", "dwh", day, path=str(tmp_path / "dwh"))
    rows = spark.table("dwh").where(F.col("date") == F.lit(day)).orderBy("country").collect()
    assert [(r["country"], r["channel_type"], r["Qualified_Visits"], r["L_Video_Call_Request"]) for r in rows] == [
        ("DE", "display", 5, 6), ("FR", "other", 5, 6),
    ]
    with pytest.raises(tables.EmptyLoad):
        web_warehouse.run_warehouse(spark, "stg", "dwh", date(2024, 5, 9))


def test_countries_that_differ_in_case_stay_apart(frame):
    rows = [(date(2024, 1, 1), c, "sm_1", 1, 1, 1, 1) for c in ("de", "DE")]
    df = frame(rows, "date date, country string, trackingcode string, bounces long, pageviews long, uniquevisitors long, visits long")
    out = web_warehouse.rollup(df).collect()
    assert [r["country"] for r in out] == ["DE", "DE"]


def test_bank_files(spark, tmp_path):
    (tmp_path / "account.asc").write_text('"account_id";"district_id";"frequency";"date"\n1;2;"POPLATEK MESICNE";930101\n')
    (tmp_path / "card.asc").write_text('"card_id";"disp_id";"type";"issued"\n1;2;"gold";"931107 00:00:00"\n')
    (tmp_path / "client.asc").write_text('"client_id";"birth_number";"district_id"\n1;"706213";18\n2;"450204";1\n')
    (tmp_path / "district.asc").write_text(
        "A1;A2;A3;A4;A5;A6;A7;A8;A9;A10;A11;A12;A13;A14;A15;A16\n69;\"Jesenik\";\"north Moravia\";42821;4;13;5;1;3;48.4;8173;?;7.01;124;?;1358\n"
    )
    folder = str(tmp_path)
    assert files.read_bank(spark, folder, "account").first()["date"] == date(1993, 1, 1)
    assert str(files.read_bank(spark, folder, "card").first()["issued"]) == "1993-11-07 00:00:00"
    people = files.read_bank(spark, folder, "client").orderBy("client_id").collect()
    assert [(p["birth_date"], p["gender"]) for p in people] == [(date(1970, 12, 13), "Female"), (date(1945, 2, 4), "Male")]
    place = files.read_bank(spark, folder, "district").first()
    assert place["A12"] is None and place["A15"] is None and place["A10"] == 48.4


def test_csv_missing_and_quotes(spark, tmp_path):
    (tmp_path / "r.csv").write_text('id,name,ms\n1,"a, b",NA\n2,c,5\n')
    df = files.read_csv(spark, str(tmp_path / "r.csv"), "id int, name string, ms int")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [(1, "a, b", None), (2, "c", 5)]
    guessed = files.read_csv(spark, str(tmp_path / "r.csv"))
    assert dict(guessed.dtypes)["ms"] == "int"
    files.export_csv(df, str(tmp_path / "out"), single=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    (tmp_path / "j.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert files.read_json(spark, str(tmp_path / "j.json"), "a int").count() == 2


def test_web_report(spark, tmp_path):
    report = {"columns": {"columnIds": ["0", "2"]}, "rows": [{"itemId": "1", "value": "2024-01-05T00:00:00", "data": [3, 4.5]}]}
    request = {"metricContainer": {"metrics": [
        {"columnId": "0", "id": "metrics/visits"}, {"columnId": "1", "id": "metrics/never"}, {"columnId": "2", "id": "metrics/orders"},
    ]}}
    (tmp_path / "report.json").write_text(json.dumps(report, indent=1))
    (tmp_path / "request.json").write_text(json.dumps(request, indent=1))
    out = web_report.run_web_report(spark, str(tmp_path / "report.json"), str(tmp_path / "request.json"))
    assert out.columns == ["itemId", "Date", "metrics/visits", "metrics/never", "metrics/orders"]
    assert tuple(out.first()) == ("1", date(2024, 1, 5), 3.0, None, 4.5)
    (tmp_path / "suites.json").write_text(json.dumps({"content": [{"collection": "x", "rsid": "a", "name": "n", "currency": "EUR"}]}))
    suites = web_report.report_suites(spark, str(tmp_path / "suites.json"), ["rsid", "name", "currency"])
    assert [tuple(r) for r in suites.collect()] == [("a", "n", "EUR")]


def test_report_ingest(spark, tmp_path):
    head = ",".join(['"Day"', *[f'"{c}"' for c in [*ad_report.TEXTS[1:], "Budget spent", *ad_report.COUNTS]]])
    row = '2024-02-03T00:00:00Z,"Seat, one",FR,c,l,x,EUR,1.5,1,2,3,4,5,6,7'
    empty = ',s,FR,c,l,x,EUR,,,,,,,,'
    (tmp_path / "report.csv").write_text("\n".join([head, row, empty]) + "\n")
    out = ad_report.run_report_ingest(spark, str(tmp_path / "report.csv"), "teaser", table_path=str(tmp_path / "t"))
    assert out.columns == ad_report.OUTPUT
    assert tuple(out.first())[:2] == (date(2024, 2, 3), "Seat, one") and out.count() == 1


def test_tables(spark, frame, tmp_path):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    df = frame([(1, "x"), (2, "y")], "a int, b string")
    tables.replace_table(df, "rt", schema, str(tmp_path / "rt"))
    tables.append(frame([("z", 3)], "b string, a int"), "rt")
    tables.append(frame([(4,)], "a int"), "rt")
    assert sorted(map(tuple, spark.table("rt").collect()), key=str) == [(1, "x"), (2, "y"), (3, "z"), (4, None)]
    tables.truncate_load(frame([(9, "q")], "a int, b string"), "rt")
    assert [tuple(r) for r in tables.table(spark, "rt", ["b"]).collect()] == [("q",)]
    tables.create_as(df, "ct", str(tmp_path / "ct"))
    with pytest.raises(Exception):
        tables.create_as(df, "ct", str(tmp_path / "ct2"))


def test_uniform_ints(spark):
    df = tables.uniform_ints(spark, 1500, {"x": (1, 10), "y": (1, 5)}, 3)
    r = df.agg(F.count("x"), F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    assert tuple(r) == (1500, 1, 10, 1, 5)


def test_feedback(spark, frame, tmp_path):
    supplier = frame([(7, "Supplier#7")], "s_suppkey long, s_name string")
    batch = frame([("Supplier#7", 4, "it's fine; DROP TABLE x")], "name string, grade int, comment string")
    supplier_view.record_feedback(batch, supplier, "grades_t", str(tmp_path / "g"))
    supplier_view.record_feedback(batch, supplier, "grades_t")
    assert [tuple(r) for r in spark.table("grades_t").collect()] == [("7", 4, "it's fine; DROP TABLE x")] * 2
