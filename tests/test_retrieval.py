"""Query texts, vectors, search, filters, re-ranking and answers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwell.functions import text as tx
from tickwell.operators import retrieval as rt
from tickwell.operators import vectors as vc
from tickwell.plans import answers
from tickwell.session import stored
from tickwell.sources import tables

AS_OF = "2024-07-01 12:00:00"


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "query, prepared, expanded",
    [
        ("Stock-PRICE, now!", "stockprice now financial market analysis",
         "stockprice now financial market analysis equity shares value cost"),
        ("Héllo, ½", "héllo ½", None),
        ("", "", None),
        ("marketing", "marketing financial market analysis", None),
        ("a b c_d", "a b cd", None),
    ],
)
def test_query_texts(spark, query, prepared, expanded):
    got = tx.prepare_query(F.lit(query))
    assert one(spark, got) == prepared
    assert one(spark, tx.expand_query(got)) == expanded


@pytest.mark.parametrize(
    "query, kind",
    [("Compare PRICE", "price_analysis"), ("trends ahead", "trend_analysis"),
     ("the future", "prediction"), ("hello", "general_analysis")],
)
def test_query_types(spark, query, kind):
    assert one(spark, tx.query_type(F.lit(query))) == kind


def test_words(spark):
    assert one(spark, tx.words(F.lit("  a \n b\tc "))) == ["a", "b", "c"]
    for text in ("", " ", "a", " a b", "a b c d", " a  b c d e"):
        got = one(spark, tx.first_words(F.lit(text), 3))
        assert got == text.split()[:3]


def test_snippets(spark):
    assert one(spark, tx.snippet(F.lit("x" * 200))) is None
    assert one(spark, tx.snippet(F.lit("x" * 201))) == "x" * 200 + "..."


def test_recency_rounds_days_down(spark):
    now = F.lit(AS_OF).cast("timestamp")
    at = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, tx.recency(at("2024-07-01 00:00:00"), now)) == 1.0
    assert one(spark, tx.recency(at("2024-07-02 00:00:00"), now)) == pytest.approx(0.99**-1)
    assert one(spark, tx.recency(F.lit(None).cast("timestamp"), now)) == 0.5


@pytest.mark.parametrize(
    "day, kind",
    [("2024-07-01", "very_fresh"), ("2024-06-29", "fresh"), ("2024-06-10", "recent"),
     ("2023-06-10", "historical"), (None, "unknown")],
)
def test_freshness(spark, day, kind):
    now = F.lit(AS_OF).cast("timestamp")
    assert one(spark, tx.freshness(F.lit(day).cast("timestamp"), now)) == kind


def test_filters(spark):
    metadata = {"a": {"lang": "en", "date": "2024-05-01"}, "b": {"lang": "en"}, "c": {"lang": "en", "date": "when"},
                "d": {"date": "2024-06-02T10:00:00"}, "e": {"lang": "en", "date": "2024-06-01"}}
    df = spark.createDataFrame(list(metadata.items()), "id string, metadata map<string,string>")

    def kept(filters):
        given = df.where(rt.matches(F.col("metadata"), filters)).select("id")
        maps = F.create_map(*[F.lit(x) for kv in filters.items() for x in kv]) if filters else F.lit(None).cast("map<string,string>")
        by_row = df.where(rt.matches_row(F.col("metadata"), maps)).select("id")
        assert sorted(given.collect()) == sorted(by_row.collect())
        return "".join(sorted(r["id"] for r in given.collect()))

    assert kept({"date": "2024-06-01"}) == "de"
    assert kept({"lang": "en"}) == "abce"
    assert kept({"lang": "en", "date": "2024-06-01"}) == "e"
    assert kept({"nothing": "x"}) == ""
    assert kept({}) == "abcde"


def test_hash_vectors(spark):
    df = spark.createDataFrame([("a b a",), ("",), (None,), ("A, b! a",)], "t string")
    rows = [r[0] for r in df.select(vc.hash_vector(F.col("t"), 16)).collect()]
    assert np.linalg.norm(rows[0]) == pytest.approx(1) and sorted(rows[0])[-2:] == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert rows[1] == rows[2] == [0.0] * 16
    assert rows[3] == rows[0]


def test_counting_words_holds_little_more_than_the_vectors(spark, monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    caught, known = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: caught.append(f) or known(kind)(f))
    vc.hash_vector(F.col("t"))
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 384, n).tolist() if n else None for n in rng.integers(0, 40, 4000)]
    buckets = pa.array(rows, pa.list_(pa.int32()))
    tracemalloc.start()
    got = caught[0](buckets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.3 * 4000 * 384 * 8
    for i in range(0, 4000, 7):
        counts = np.bincount(rows[i] or [], minlength=384)
        assert np.allclose(got[i].values.to_numpy(), counts / max(np.linalg.norm(counts), 1))


def test_documents_are_not_packed_for_few_queries(spark):
    """A batch of packed documents joined to queries holds all vectors of a task."""
    docs = spark.range(3000).selectExpr("id", "if(id = 5, null, array(cos(id), sin(id))) as embedding")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, embedding array<double>")
    hits = vc.similar(docs.coalesce(1), queries, k=3, threshold=0.5)
    assert "Join" not in hits._jdf.queryExecution().executedPlan().toString()
    got = {(r["query_id"], r["rank"]): r["id"] for r in hits.collect()}
    for q, f in ((1, math.cos), (2, math.sin)):
        best = sorted((i for i in range(3000) if i != 5), key=lambda i: (-round(f(i), 9), i))[:3]
        assert [got[q, r] for r in (1, 2, 3)] == best


def test_cosine(spark):
    pair = lambda a, b: vc.cosine(F.array(*map(F.lit, a)), F.array(*map(F.lit, b)))
    assert one(spark, pair([1.0, 2.0], [2.0, 4.0])) == pytest.approx(1)
    assert one(spark, pair([0.0, 0.0], [2.0, 4.0])) is None


def vectors_table(spark, n, dims, seed, name):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, dims))
    rows = [(i, values[i].tolist()) for i in range(n)]
    return values, spark.createDataFrame(rows, f"{name} long, embedding array<double>")


def brute(docs, queries, k, threshold):
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = unit(queries) @ unit(docs).T
    hits = {}
    for q, row in enumerate(sims):
        order = sorted((-round(s, 9), d) for d, s in enumerate(row) if s > threshold)
        hits[q] = [d for _, d in order[:k]]
    return hits


def found(hits):
    result = {}
    for r in hits.orderBy("query_id", "rank").collect():
        result.setdefault(r["query_id"], []).append(r["id"])
    return result


@pytest.mark.parametrize("batch", [4096, 7])
def test_search_equals_brute_force(spark, batch):
    d, docs = vectors_table(spark, 700, 8, 1, "id")
    d[5:9] = d[4]
    docs = spark.createDataFrame([(i, d[i].tolist()) for i in range(len(d))], "id long, embedding array<double>")
    odd = spark.createDataFrame([(9001, [0.0] * 8), (9002, None)], docs.schema)
    q, queries = vectors_table(spark, 30, 8, 2, "query_id")
    want = brute(d, q, 4, 0.2)
    got = found(vc.similar(docs.unionByName(odd).repartition(5), queries, 4, 0.2, batch=batch))
    assert got == {k: v for k, v in want.items() if v}


def test_search_with_own_depths(spark):
    d, docs = vectors_table(spark, 200, 6, 3, "id")
    q, queries = vectors_table(spark, 3, 6, 4, "query_id")
    queries = queries.withColumn("top_k", F.when(F.col("query_id") == 0, 2).when(F.col("query_id") == 1, 0))
    got = found(vc.similar(docs.repartition(4), queries, 7, -1.0))
    assert [len(got[i]) for i in range(3)] == [2, 7, 7]
    assert got[0] == brute(d, q, 2, -1.0)[0]


@pytest.mark.parametrize("probes, side", [(1, 1 << 20), (3, 1_000), (100, 1 << 20)])
def test_cells_find_all(spark, monkeypatch, probes, side):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(8, 16)) * 3
    d = centres[rng.integers(0, 8, 800)] + rng.normal(size=(800, 16))
    docs = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(d)] + [(900, [0.0] * 16)], "id long, embedding array<double>")
    q = np.concatenate([centres[rng.integers(0, 8, 15)] + rng.normal(size=(15, 16)), rng.normal(size=(5, 16))])
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, embedding array<double>")
    placed, cells = vc.assign_cells(docs, lists=8)
    assert placed.count() == 801
    monkeypatch.setattr(vc, "BLOCK", 20)
    monkeypatch.setattr(vc, "SIDE_BYTES", side)
    packed = stored(vc.pack_cells(placed, cells, parts=5))
    assert packed.agg(F.sum("n")).first()[0] == 800 and packed.count() >= 40
    got = found(vc.similar_in_cells(packed, cells, queries, 5, 0.1, probes=probes, batch=7))
    assert got == {k: v for k, v in brute(d, q, 5, 0.1).items() if v}
    none = vc.similar_in_cells(packed, cells, queries.limit(0), 5, 0.1)
    assert none.count() == 0 and none.columns == ["query_id", "id", "similarity", "rank"]


def test_a_crowded_cell_is_spread(spark, monkeypatch):
    rng = np.random.default_rng(3)
    # Half of all vectors around one centre.
    d = np.concatenate([rng.normal(size=(1, 8)) * 4 + rng.normal(size=(1_000, 8)), rng.normal(size=(1_000, 8))])
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d)], "id long, embedding array<double>")
    placed, cells = vc.assign_cells(docs, lists=4)
    monkeypatch.setattr(vc, "BLOCK", 50)
    packed = stored(vc.pack_cells(placed, cells, parts=10).withColumn("part", F.spark_partition_id()))
    most = packed.groupBy("cell").agg(F.sum("n").alias("n"), F.countDistinct("part").alias("parts"), F.count("*").alias("blocks"))
    crowded = most.orderBy(F.desc("n")).first()
    assert crowded["n"] >= 900 and crowded["parts"] >= 4 and crowded["blocks"] >= 15
    # Blocks of a cell lie one behind the other, so their bounds differ.
    spans = packed.where(F.col("cell") == crowded["cell"]).orderBy("low").select("low", "high").collect()
    assert all(a["high"] <= b["low"] + 1e-12 for a, b in zip(spans, spans[1:]))
    q = d[:30]
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, embedding array<double>")
    assert found(vc.similar_in_cells(packed.drop("part"), cells, queries, 3, 0.2)) == brute(d, q, 3, 0.2)


def test_more_queries_than_a_task_should_hold(spark):
    d, docs = vectors_table(spark, 300, 8, 1, "id")
    q, queries = vectors_table(spark, 12_000, 8, 2, "query_id")
    got = found(vc.similar(docs, queries, 2, 0.2))
    assert got == {k: v for k, v in brute(d, q, 2, 0.2).items() if v}


@pytest.mark.parametrize("side", [1, 3_000, 1 << 30])
def test_grid_of_documents_and_queries(spark, monkeypatch, side):
    monkeypatch.setattr(vc, "SENT_BYTES", 0)
    monkeypatch.setattr(vc, "SIDE_BYTES", side)
    monkeypatch.setattr(vc, "BLOCK", 64)
    monkeypatch.setattr(vc, "HELD_HITS", 500)
    d, docs = vectors_table(spark, 300, 8, 1, "id")
    q, queries = vectors_table(spark, 120, 8, 2, "query_id")
    odd = spark.createDataFrame([(900, [0.0] * 8), (901, None)], docs.schema)
    got = found(vc.similar(docs.unionByName(odd).repartition(3), queries, 4, 0.2, batch=50))
    assert got == {k: v for k, v in brute(d, q, 4, 0.2).items() if v}
    none = docs.limit(0)
    assert vc.similar(none, queries, 4, 0.2).count() == 0


def test_sides_of_a_grid():
    side = vc.SIDE_BYTES
    assert vc.grid(100 * side, 3.5 * side, 1000) == (100, 4)
    assert vc.grid(0, 1, 1) == (1, 1) and vc.grid(10, 9 * side, 5) == (1, 5)


def test_many_queries_are_dealt_out_and_not_sent(spark):
    unit = F.array(*[F.sin(F.col("id") + i) for i in range(32)])
    queries = spark.range(60_000).select(F.col("id").alias("query_id"), unit.alias("embedding"))
    docs = spark.range(5_000).select("id", unit.alias("embedding"))
    plan = vc.similar(docs, queries, 5, 0.7)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Broadcast" not in plan and "FlatMapCoGroupsInArrow" in plan
    few = vc.similar(docs, queries.limit(50), 5, 0.7)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in few and "CoGroups" not in few


def corpus(spark):
    rows = [
        (1, "stock report alpha", {"title": "Stock news", "date": "2024-06-30"}),
        (2, "stock report beta", {"title": "Other", "date": "2020-01-01", "lang": "en"}),
        (3, "equity shares of companies", {"title": "Shares"}),
        (4, "cooking with onions", {}),
    ]
    docs = spark.createDataFrame(rows, "id long, content string, metadata map<string,string>")
    return docs.withColumn("embedding", vc.hash_vector(F.col("content")))


def prepared(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "query_id long, query string")
    return rt.prepare(df, vc.hash_vector)


def test_expansion_fills_up_and_keeps_duplicates(spark):
    queries = prepared(spark, "stock report", "onions")
    hits = rt.base_hits(corpus(spark), queries, k=5, threshold=0.25)
    rows = [(r["query_id"], r["id"], r["by_expansion"]) for r in hits.orderBy("query_id", "place").collect()]
    first = [r for r in rows if r[0] == 0]
    assert [r[1] for r in first if not r[2]] == [1, 2]
    again = [r[1] for r in first if r[2]]
    assert 3 in again and len(first) <= 5 and len(set(again) & {1, 2}) > 0
    assert [r for r in rows if r[0] == 1] == [(1, 4, False)]
    unique = rt.base_hits(corpus(spark), queries, k=5, threshold=0.25, dedupe=True).where("query_id = 0")
    assert sorted(r["id"] for r in unique.collect()) == [1, 2, 3]
    assert rt.base_hits(corpus(spark), queries, k=2, threshold=0.25).where("by_expansion").count() == 0


def test_rerank_weighs_titles_and_dates(spark):
    queries = prepared(spark, "stock report", "onions")
    got = rt.retrieve(corpus(spark), queries, AS_OF, k=2, threshold=0.25).collect()
    rows = {(r["query_id"], r["id"]): r for r in got}
    top = rows[(0, 1)]
    assert top["position"] == 1
    assert top["relevance"] == pytest.approx(min(1.0, top["similarity"] + 0.1))
    assert top["score"] == pytest.approx(0.7 * top["relevance"] + 0.3 * 0.99)
    alone = rows[(1, 4)]
    assert alone["score"] == alone["similarity"] and alone["recency"] == 0.5


def test_filters_come_after_the_search_unless_asked(spark):
    queries = prepared(spark, "stock report")
    options = dict(k=1, threshold=0.1, filters={"lang": "en"})
    assert rt.retrieve(corpus(spark), queries, AS_OF, **options).count() == 0
    kept = rt.retrieve(corpus(spark), queries, AS_OF, prefilter=True, **options).collect()
    assert [r["id"] for r in kept] == [2]


def records(spark, rows):
    return spark.createDataFrame(
        rows, "query_id long, position int, id long, content string, metadata map<string,string>, "
        "similarity double, financial_data array<struct<ts:timestamp_ntz, fields:map<string,double>>>")


def test_answers(spark):
    from datetime import datetime

    day = lambda d: datetime(2024, 1, d)
    bar = lambda c: {"open": 1.0, "high": 1.0, "low": 1.0, "close": c, "volume": 1.0}
    short = {"revenue": 1.0, "net_income": 2.0}
    hits = records(spark, [
        (1, 1, 10, "first", {"title": "T", "date": "2024-06-30"}, 0.91234, [(day(1), bar(2.0)), (day(3), bar(1234.5))]),
        (1, 2, 11, "second", {}, 0.5, None),
        (2, 1, 12, "third", {"source": "s"}, 0.4, [(day(2), short), (day(1), bar(3.0))]),
    ])
    queries = spark.createDataFrame([(1, "price?"), (2, "trend"), (3, "hello")], "query_id long, query string")
    got = {r["query_id"]: r for r in answers.answer_contexts(queries, hits, AS_OF).collect()}
    assert got[1]["context"] == (
        "Retrieved Information:\nfirst\nsecond\n\nFinancial Data Summary:\n"
        "Price data available from 2024-01-01 00:00:00 to 2024-01-03 00:00:00. Price range: $2.00 - $1234.50\n\n"
        "Visualizations Generated:\n- price_chart: chart chart showing price chart\n"
        "- technical_indicators: indicators chart showing technical indicators\n\nUser Query: price?")
    names = got[2]["context"].split("Time series data for ")[1].split(" from 2024-01-01 00:00:00 to 2024-01-02")[0].split(", ")
    # Maps from Python come without an order of their own.
    assert set(names[:2]) == set(short) and set(names[2:]) == {"open", "high", "low", "close", "volume"}
    assert "- net_income_chart: chart chart showing net income chart" in got[2]["context"]
    assert got[3]["context"] == "Retrieved Information:\n\nUser Query: hello"
    assert [tuple(s) for s in got[1]["sources"]] == [
        ("T", "2024-06-30", "Unknown source", "91.23%"), ("Untitled", "Unknown date", "Unknown source", "50.00%")]
    assert (got[1]["data_freshness"], got[2]["data_freshness"], got[3]["data_freshness"]) == ("fresh", "unknown", "unknown")
    assert got[3]["sources"] == [] and got[2]["query_type"] == "trend_analysis"
    assert got[1]["prompt"].endswith("Analysis:") and got[1]["context"] in got[1]["prompt"]


def test_answers_with_long_series(spark):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    tick = lambda i: {c: float(i % 97) for c in ("open", "high", "low", "close", "volume")}
    long = [(start + timedelta(minutes=17 * i), tick(i)) for i in range(700)]
    late = [(start + timedelta(minutes=17 * i), tick(i)) for i in range(700, 1_500)]
    other = [(t, {"b": 1.0, "a": 2.0}) for t, _ in long[:30]]
    hits = records(spark, [
        (1, 2, 11, "second", {}, 0.5, late), (1, 1, 10, "first", {}, 0.9, long), (2, 1, 12, "third", {}, 0.4, long),
        (3, 1, 13, "fourth", {}, 0.4, other), (4, 1, 14, "fifth", {}, 0.4, []),
    ])
    queries = spark.createDataFrame([(i, "trend") for i in range(1, 6)], "query_id long, query string")
    rows = hits.select("query_id", "position", F.posexplode("financial_data").alias("pos", "r"))
    rows = rows.select("query_id", "r.ts", (F.col("position") * 10_000 + F.col("pos")).cast("long").alias("row_id"), "r.fields")
    for points in (1000, 20, 5_000):
        want = {r["query_id"]: r["summary"] for r in answers.summaries(rows, answers.classify(rows), points).collect()}
        got = {r["query_id"]: r["context"] for r in answers.answer_contexts(queries, hits, AS_OF, points).collect()}
        assert sorted(want) == [1, 2, 3]
        for i in range(1, 6):
            assert ("Financial Data Summary:\n" in got[i]) == (i in want)
            # Maps from Python come without an order of their own, but have one here.
            assert i not in want or f"Financial Data Summary:\n{want[i]}\n" in got[i]


def test_mixed_records_are_no_ohlcv(spark):
    full = {"open": 1.0, "high": 1.0, "low": 1.0, "close": None, "volume": 1.0}
    less = {k: v for k, v in full.items() if k != "volume"}
    df = spark.createDataFrame([(1, full), (1, less), (2, full)], "query_id long, fields map<string,double>")
    assert {r["query_id"]: r["is_ohlcv"] for r in answers.classify(df).collect()} == {1: False, 2: True}


def test_metric_titles(spark):
    assert one(spark, tx.metric_title(F.lit("net_income"))) == "Net Income Trend"


def test_document_store(spark, tmp_path):
    path = str(tmp_path / "docs")
    tables.append_documents(corpus(spark), path, AS_OF, size=384)
    tables.append_documents(corpus(spark).drop("id", "metadata"), path, AS_OF)
    back = tables.read_documents(spark, path)
    assert back.count() == 8 and back.where("metadata is null or id is null").count() == 0
    assert back.select("id").distinct().count() == 8
    with pytest.raises(Exception, match="does not have 3 values"):
        tables.append_documents(corpus(spark), path, AS_OF, size=3)


def test_interleaved_appends_have_ids_of_their_own(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "docs")
    docs = corpus(spark).drop("id").repartition(3)
    numbers = []

    def during_another(session, at):
        """A second append begins and ends before the first one writes."""
        own = reserve(session, at)
        numbers.append(own)
        if len(numbers) == 1:
            tables.append_documents(docs, path, AS_OF)
        return own

    reserve = tables.reserve
    monkeypatch.setattr(tables, "reserve", during_another)
    tables.append_documents(docs, path, AS_OF)
    monkeypatch.undo()
    seen = tables.append_documents(corpus(spark), path, AS_OF)
    back = tables.read_documents(spark, path)
    assert sorted(numbers) == [1, 2] and seen.get["rows"] == 4
    assert back.count() == 12 and back.select("id").distinct().count() == 12
    assert back.where(f"id < {1 << 44}").count() == 4
    with pytest.raises(Exception, match="given by the table"):
        tables.append_documents(back.where(f"id >= {1 << 44}"), path, AS_OF)


def test_an_append_reads_nothing_of_the_table(spark, tmp_path):
    path = str(tmp_path / "docs")
    tables.append_documents(corpus(spark), path, AS_OF)
    for file in (tmp_path / "docs").glob("*.parquet"):
        file.write_bytes(b"not a table any more")
    assert tables.append_documents(corpus(spark).drop("id"), path, AS_OF).get["rows"] == 4
