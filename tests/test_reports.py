"""Filings, reports, validation, tables at rest."""

import json
import math

import pytest
from pyspark.sql import functions as F

from tickwell.functions import numbers as nm
from tickwell.functions import text as tx
from tickwell.operators import quality
from tickwell.plans import reports
from tickwell.schema import METRICS
from tickwell.sources import filings, tables

AS_OF = "2024-06-30 08:00:00"


def facts_doc(**concepts):
    return json.dumps({"facts": {"us-gaap": concepts}})


def usd(*entries):
    return {"units": {"USD": list(entries)}}


def revenue_of(spark, doc):
    df = spark.createDataFrame([(doc,)], "doc string")
    return filings.parse_facts(df).first()["revenue"]


@pytest.mark.parametrize(
    "doc, want",
    [
        (facts_doc(Revenues=usd({"end": "2023", "val": 1}, {"val": 9}, {"end": "2024", "val": 2.5}, {"end": "2024", "val": 7})), 2.5),
        ("{}", None),
        (json.dumps({"facts": {}}), None),
        (facts_doc(Assets=usd({"end": "2024", "val": 1})), None),
        (facts_doc(Revenues={"units": {}}), None),
        (facts_doc(Revenues={"units": {"EUR": [{"end": "2020", "val": 3}], "USD": [{"end": "2024", "val": 4}]}}), 3.0),
        (facts_doc(Revenues=usd({"end": "2023", "val": 1}, {"end": "2024", "val": "n/a"})), None),
        (facts_doc(Revenues=usd({"val": 6})), 6.0),
        (facts_doc(Revenues=usd()), None),
    ],
)
def test_latest_fact(spark, doc, want):
    assert revenue_of(spark, doc) == want


def test_latest_fact_of_rows(spark):
    rows = [
        ("1", "revenue", 0, 0, "2023", "1"), ("1", "revenue", 0, 1, None, "9"),
        ("1", "revenue", 0, 2, "2024", "2.5"), ("1", "revenue", 0, 3, "2024", "7"),
        ("1", "revenue", 1, 0, "2030", "8"), ("2", "revenue", 0, 0, "2024", "n/a"),
    ]
    df = spark.createDataFrame(rows, "cik string, concept string, unit_pos int, pos int, end string, val string")
    got = {r["cik"]: r["value"] for r in filings.latest_fact_rows(df).collect()}
    assert got == {"1": 2.5, "2": None}


def test_identifiers(spark):
    df = spark.createDataFrame([("320193",), ("0000320193",), ("12345678901",)], "c string")
    got = [tuple(r) for r in df.select(nm.full_cik(F.col("c")), nm.short_cik(F.col("c"))).collect()]
    assert got == [("0000320193", "320193"), ("0000320193", "320193"), ("12345678901", "12345678901")]
    df = spark.createDataFrame([("0001-22-333",), (None,)], "a string")
    assert [r[0] for r in df.select(nm.plain_accession(F.col("a"))).collect()] == ["000122333", ""]


def test_directory_keeps_the_order_of_the_file(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps(
        {"0": {"cik_str": 320193, "ticker": "A", "title": "Alpha"}, "7": {"cik_str": 5, "ticker": "B", "title": "Beta"},
         "3": {"cik_str": 12, "ticker": "C", "title": "Gamma"}}))
    directory = filings.company_directory(filings.json_files(spark, str(tmp_path / "d.json")))
    got = [(r["pos"], r["cik"], r["title"]) for r in directory.orderBy("pos").collect()]
    assert got == [(0, "0000320193", "Alpha"), (1, "0000000005", "Beta"), (2, "0000000012", "Gamma")]
    assert filings.first_companies(directory, 2).count() == 2


def facts_table(spark, rows):
    values = ", ".join(f"{m} double" for m in METRICS)
    return spark.createDataFrame(rows, f"cik string, has_facts boolean, {values}")


def test_names_and_records(spark):
    facts = facts_table(spark, [("1", True, 1.0, 2.0, 3.0, 4.0, 5.0), ("2", True, *[None] * 5),
                                ("3", True, 1.0, 1.0, 1.0, 1.0, 1.0), ("4", False, *[None] * 5)])
    subs = filings.parse_submissions(
        spark.createDataFrame([("1", '{"name": "One"}'), ("2", "{}")], "cik string, doc string"))
    got = {r["cik"]: r for r in reports.report_records(facts, subs, AS_OF).collect()}
    assert {k: r["company_name"] for k, r in got.items()} == {"1": "One", "2": "Unknown", "3": "Company 3"}
    assert got["1"]["fiscal_year"] == 2024 and got["1"]["filing_type"] == "10-K"


def test_metric_bounds(spark):
    values = [1e12, 1e12 + 1, -1e12, None, float("nan"), float("inf"), -1e12 - 1]
    facts = facts_table(spark, [(str(i), True, v, None, None, None, None) for i, v in enumerate(values)])
    checked = quality.validate(facts)
    got = [r["valid"] for r in checked.orderBy("cik").collect()]
    assert got == [True, False, True, True, True, True, False]
    assert quality.accepted(checked).count() == 5
    assert [r["violations"] for r in quality.rejected(checked).collect()] == [["revenue"]] * 2


def test_ratios_of_nothing(spark):
    facts = facts_table(spark, [("1", True, 0.0, 1.0, 2.0, 0.0, 1.0), ("2", True, *[None] * 5),
                                ("3", True, 4.0, 1.0, 6.0, 3.0, None)])
    got = [(r["current_ratio"], r["profit_margin"]) for r in reports.with_ratios(facts).orderBy("cik").collect()]
    assert got == [(None, None), (None, None), (2.0, 0.25)]


def test_report_text(spark):
    df = spark.createDataFrame(
        [("0000000001", "One", AS_OF, 2024, 0.125, 2.675, -5.0, 1e12, None)],
        "cik string, company_name string, t string, fiscal_year int, " + ", ".join(f"{m} double" for m in METRICS),
    ).withColumn("filing_date", F.col("t").cast("timestamp"))
    pad = " " * 8
    lines = ["", "Financial Report for One (CIK: 0000000001)", "Filing Date: 2024-06-30 08:00:00+00:00",
             "Fiscal Year: 2024", "", "Key Financial Metrics:", "- Revenue: $0.12", "- Net Income: $2.67",
             "- Total Assets: $-5.00", "- Total Liabilities: $1,000,000,000,000.00", "- Operating Cash Flow: $nan", ""]
    want = "\n".join(pad + line if i else line for i, line in enumerate(lines))
    assert df.select(tx.report_text()).first()[0] == want


def test_money_rounds_as_python(spark):
    values = [0.125, 2.675, -5.0, 1234.5, 0.005, 1.005, 99999.995, -0.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(tx.grouped_money(F.col("v"))).collect()] == [f"{v:,.2f}" for v in values]


def test_impute_and_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0)], "a double, b double")
    full = quality.impute_mean(df, ["a"])
    assert sorted(r["a"] for r in full.collect()) == [1.0, 2.0, 3.0]
    got = sorted(r["a"] for r in quality.standard_scale(full, ["a", "b"]).collect())
    assert got == pytest.approx([-math.sqrt(1.5), 0.0, math.sqrt(1.5)])
    assert {r["b"] for r in quality.standard_scale(full, ["a", "b"]).collect()} == {0.0}


def finished(spark):
    facts = facts_table(spark, [(str(i), True, 1.0 + i, 2.0, 3.0, float(i), None) for i in range(20)])
    facts = facts.withColumn("fiscal_year", (F.col("cik").cast("int") % 3 + 2020).cast("int"))
    subs = spark.createDataFrame([], "cik string, company_name string")
    return reports.finished_reports(facts, subs, AS_OF)


def test_report_table_and_export(spark, tmp_path):
    path = str(tmp_path / "reports")
    assert tables.append_reports(finished(spark), path).get["rows"] == 20
    tables.append_reports(finished(spark), path)
    back = tables.read_reports(spark, path)
    assert back.count() == 40 and back.where("current_ratio is null").count() == 2
    assert sorted(p.name for p in (tmp_path / "reports").glob("fiscal_year=*")) == [
        "fiscal_year=2020", "fiscal_year=2021", "fiscal_year=2022"]
    out = str(tmp_path / "training")
    assert tables.export_training(back, out).get["rows"] == 40
    line = json.loads(next((tmp_path / "training").glob("part-*")).read_text().splitlines()[0])
    assert line["output"]["type"] == "financial_report"
    assert set(line["output"]["metrics"]) == {*METRICS, "current_ratio", "profit_margin"}
    assert line["output"]["metrics"]["operating_cash_flow"] is None


def test_csv_files(spark, tmp_path):
    full = finished(spark).drop("current_ratio", "profit_margin", "text_content")
    for name in ("a", "b"):
        tables.write_report_csv(full, str(tmp_path / name))
    back = tables.read_report_csv(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert back.count() == 40
    assert back.distinct().exceptAll(full).count() == 0


def test_ragged_records(spark):
    a = spark.sql("select 1 x, 'p' name")
    b = spark.sql("select 2 x, 3.5D y")
    got = sorted(tables.ragged_union([a, b]).select("x", "name", "y").collect())
    assert [tuple(r) for r in got] == [(1, "p", None), (2, None, 3.5)]


def test_landed_files_to_report_table(spark, tmp_path):
    names = {1: "Alpha", 2: None, 3: "Gamma", 4: "Delta"}
    directory = {str(i): {"cik_str": n, "ticker": f"T{n}", "title": f"C{n}"} for i, n in enumerate([3, 1, 2, 9, 4])}
    for folder in ("facts", "subs"):
        (tmp_path / folder).mkdir()
    (tmp_path / "directory.json").write_text(json.dumps(directory))
    for n, name in names.items():
        facts = facts_doc(Revenues=usd({"end": "2023", "val": n * 10}), NetIncomeLoss=usd({"end": "2023", "val": n}),
                          Assets=usd({"end": "2023", "val": 1e13 if n == 3 else 6}), Liabilities=usd({"end": "2023", "val": 3}))
        (tmp_path / "facts" / f"CIK{n:010d}.json").write_text(facts)
        if name:
            (tmp_path / "subs" / f"CIK{n:010d}.json").write_text(json.dumps({"name": name}))
    table = str(tmp_path / "table")
    seen = reports.load_landed(spark, str(tmp_path / "directory.json"), str(tmp_path / "facts"),
                               str(tmp_path / "subs"), table, AS_OF, companies=4)
    assert seen.get["rows"] == 2
    back = {r["cik"]: r for r in tables.read_reports(spark, table).collect()}
    assert {k: r["company_name"] for k, r in back.items()} == {
        "0000000001": "Alpha", "0000000002": "Company 0000000002"}
    row = back["0000000001"]
    assert (row["current_ratio"], row["profit_margin"], row["fiscal_year"]) == (2.0, 0.1, 2024)
    assert len(row["embeddings"]) == 384 and row["id"] is not None and str(row["created_at"])[:10] == "2024-06-30"
    assert "Alpha (CIK: 0000000001)" in row["text_content"]


def test_bundled_files_to_report_table(spark, tmp_path):
    from workload import queries

    n = 400
    docs = spark.range(n).select(F.lpad(F.col("id").cast("string"), 10, "0").alias("cik"), F.lit(facts_doc(
        Revenues=usd({"end": "2023", "val": 8}), NetIncomeLoss=usd({"end": "2023", "val": 2}))).alias("doc"))
    facts = queries._land(docs.unionByName(spark.sql("select null cik, '{}' doc")), str(tmp_path / "facts"))
    names = docs.where("cast(cik as int) % 4 = 0").withColumn("doc", F.to_json(F.struct(F.concat(F.lit("N"), "cik").alias("name"))))
    subs = queries._land(names, str(tmp_path / "subs"))
    # Files and folders do not become more with the companies.
    assert len(list((tmp_path / "facts").iterdir())) + len(list((tmp_path / "subs").iterdir())) < 100
    entries = F.create_map(F.col("cik"), F.struct(F.col("cik").alias("cik_str"), F.lit("T").alias("ticker"), F.lit("C").alias("title")))
    listed = docs.where("cast(cik as int) != 7").select("cik", F.to_json(entries).alias("doc"))
    directory = filings.bundle(listed.withColumnRenamed("cik", "file"), str(tmp_path / "directory"))
    table = str(tmp_path / "table")
    reports.load_landed(spark, directory, facts, subs, table, AS_OF, companies=None, bundled=True)
    back = {int(r["cik"]): r for r in tables.read_reports(spark, table).collect()}
    assert sorted(back) == [i for i in range(n) if i != 7]
    assert back[8]["company_name"] == "N0000000008" and back[9]["company_name"] == "Company 0000000009"
    assert back[9]["profit_margin"] == 0.25
    assert filings.company_files(spark, facts, bundled=True).where("cik = '0000000000'").count() == 2


def test_times_show_a_fraction_where_there_is_one(spark):
    from tickwell.functions.text import shown_time

    rows = spark.sql("select timestamp'2024-01-02 03:04:05' a, timestamp'2024-01-02 03:04:05.25' b")
    got = rows.select(shown_time(F.col("a")), shown_time(F.col("b"))).first()
    assert tuple(got) == ("2024-01-02 03:04:05", "2024-01-02 03:04:05.250000")
