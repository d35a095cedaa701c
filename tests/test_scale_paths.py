"""The ways taken on large tables, forced on small ones, against the same SQL."""

from functools import partial
from pathlib import Path

import pytest

import workload.queries as wq
from tests.compare import connect, difference
from tickwell.operators import dealt, retrieval, vectors
from workload.oracle import ORACLE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def same(spark, con, name):
    return difference(spark, con, SF, wq.QUERIES[name], ORACLE[name])


CUT = [
    "moving_averages", "rsi_14", "bollinger_20", "price_changes", "macd", "returns", "tick_stats",
    "line_points",
]


@pytest.mark.parametrize("name", CUT)
def test_cut_series(spark, con, monkeypatch, name):
    monkeypatch.setattr(wq.dl, "deal", partial(dealt.deal, parts=60))
    assert same(spark, con, name) is None


@pytest.mark.parametrize(
    "name", ["daily_bars_auto_width", "series_resample_sum", "token_sequences", "vector_cosine", "returns"]
)
def test_tables_too_large_to_broadcast(spark, con, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert same(spark, con, name) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["expansion_union", "rerank", "similarity_topk", "answer_context"])
def test_many_blocks_of_queries(spark, con, monkeypatch, name):
    similar = partial(vectors.similar, batch=7)
    monkeypatch.setattr(retrieval, "similar", similar)
    monkeypatch.setattr(vectors, "similar", similar)
    assert same(spark, con, name) is None


@pytest.mark.parametrize("partitions", ["1", "64"])
@pytest.mark.parametrize(
    "name", ["ohlcv_bars_auto_width", "series_gap_fill", "macd", "financial_reports", "token_batches", "rerank"]
)
def test_number_of_partitions(spark, con, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert same(spark, con, name) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
