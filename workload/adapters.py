"""The given tables read as ticks, daily series, filings, documents and queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.fixed_values import CONCEPTS, TAXONOMY
from tickwell.functions.numbers import full_cik
from tickwell.functions.text import first_words
from tickwell.operators.bars import DAY, bars, tick_prices
from tickwell.operators.vectors import hash_vector
from tickwell.schema import METRICS
from tickwell.session import use_utc
from tickwell.sources.tables import spread

AS_OF = "2024-07-01 12:00:00"
KEYWORDS = ["stock", "price", "Market trend", "forecast", ""]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf}/{name}.parquet")


def ticks(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("symbol"),
        "ts",
        F.col("event_id").alias("row_id"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )


PRICES = tick_prices("close", "volume")


def daily(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("row_id"),
        F.col("o_totalprice").alias("price"),
        F.when(F.col("o_orderstatus") != "P", F.sqrt("o_totalprice")).alias("settled"),
    )


def yearly_metrics(spark, sf) -> DataFrame:
    """(custkey, fiscal_year, five metrics), nulls where nothing adds up.

    Lines are summed per order before any join, so an order of any length
    moves as one row.
    """
    # Whole cents and hundredths: sums of whole numbers are exact in any order.
    hundredths = lambda c: F.round(F.col(c) * 100).cast("bigint")
    price, tax, discount = (hundredths(f"l_{c}") for c in ("extendedprice", "tax", "discount"))
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum(price * 100).alias("revenue"),
        F.sum(price * (1 + tax - discount)).alias("net_income"),
        F.sum(price * (100 + tax)).alias("total_assets"),
        F.sum(F.when(F.col("l_returnflag") == "R", price * 100)).alias("total_liabilities"),
        F.sum(F.when(F.col("l_linestatus") == "F", price * (100 - discount))).alias(
            "operating_cash_flow"
        ),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").alias("fiscal_year")
    )
    joined = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    sums = joined.groupBy(F.col("o_custkey").alias("custkey"), "fiscal_year").agg(
        *[(F.sum(m) / 10_000).alias(m) for m in METRICS]
    )
    return sums.withColumn("total_liabilities", F.coalesce("total_liabilities", F.lit(0.0)))


def submissions(spark, sf) -> DataFrame:
    """Submission documents: none for customers in debt, no name in one segment."""
    doc = F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("{}")).otherwise(
        F.to_json(F.struct(F.col("c_name").alias("name")))
    )
    customers = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    return customers.select(full_cik(F.col("c_custkey")).alias("cik"), doc.alias("doc"))


def fact_documents(spark, sf) -> DataFrame:
    """One companyfacts document per customer: every metric with one entry
    per year in USD, years with an odd number first, then a unit EUR."""
    metrics = yearly_metrics(spark, sf)
    end = F.concat(F.col("fiscal_year").cast("string"), F.lit("-12-31"))
    entries = {
        m: F.sort_array(
            F.collect_list(
                F.when(
                    F.col(m).isNotNull(),
                    F.struct(
                        (F.col("fiscal_year") % 2 == 0).alias("even"),
                        end.alias("end"),
                        F.format_string("%.4f", F.col(m)).alias("val"),
                    ),
                )
            )
        )
        for m in METRICS
    }
    per_company = metrics.groupBy("custkey").agg(*[e.alias(m) for m, e in entries.items()])

    def concept(m: str):
        usd = F.transform(F.col(m), lambda e: F.struct(e["end"].alias("end"), e["val"].alias("val")))
        eur = F.array(F.struct(F.lit("2999-12-31").alias("end"), F.lit("1").alias("val")))
        return F.struct(F.create_map(F.lit("USD"), usd, F.lit("EUR"), eur).alias("units"))

    pairs = [x for m in METRICS for x in (F.lit(CONCEPTS[m]), concept(m))]
    facts = F.struct(F.create_map(F.lit(TAXONOMY), F.create_map(*pairs)).alias("facts"))
    return per_company.select(full_cik(F.col("custkey")).alias("cik"), F.to_json(facts).alias("doc"))


def yearly_facts(spark, sf) -> DataFrame:
    """The metrics as records per company and year; without a cash flow there
    are no facts."""
    return yearly_metrics(spark, sf).select(
        full_cik(F.col("custkey")).alias("cik"),
        "fiscal_year",
        *METRICS,
        F.col("operating_cash_flow").isNotNull().alias("has_facts"),
    )


def metadata():
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    title = F.array_join(first_words(F.col("text"), 5), " ")
    named = F.create_map(
        F.lit("title"), title, F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")
    )
    dated = F.create_map(F.lit("date"), day.cast("string"))
    return F.when(F.col("doc_id") % 7 == 3, named).otherwise(F.map_concat(named, dated))


def texts(spark, sf) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def documents(spark, sf, vectors: bool = True) -> DataFrame:
    docs = texts(spark, sf)
    columns = [F.col("doc_id").alias("id"), F.col("text").alias("content"), metadata().alias("metadata")]
    if vectors:
        columns.append(hash_vector(F.col("text")).alias("embedding"))
    return docs.select(*columns)


def user_series(
    spark, sf, users: DataFrame | None = None, crews: int | None = None, width: int = DAY
) -> DataFrame:
    """Bars per user as records (ts, fields); users whose number divides by
    three have no volume. ``users`` (id) names the users that are needed;
    with ``crews`` users are taken together by the rest of their number."""
    events = table(spark, sf, "events")
    if users is not None:
        events = events.join(users, F.col("user_id") == F.col("id"), "left_semi")
    events = events.select(
        (F.col("user_id") % crews if crews else F.col("user_id")).alias("user_id"),
        "ts",
        F.col("event_id").alias("row_id"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )
    days = bars(events, width, by=["user_id"], prices=PRICES)
    four = [x for c in ("open", "high", "low", "close") for x in (F.lit(c), F.col(c))]
    fields = F.when(F.col("user_id") % 3 == 0, F.create_map(*four)).otherwise(
        F.create_map(*four, F.lit("volume"), F.col("volume"))
    )
    return days.select("user_id", "ts", fields.alias("fields"))


def attached_records(spark, sf, users: DataFrame | None = None, **series) -> DataFrame:
    """(user_id, financial_data): the bars of a user or crew in one array of records,
    one record per day or hour, so their number is limited by the calendar."""
    by_time = lambda a, b: F.sign(F.unix_seconds(a["ts"].cast("timestamp")) - F.unix_seconds(b["ts"].cast("timestamp"))).cast("int")
    records = F.array_sort(F.collect_list(F.struct("ts", "fields")), by_time)
    return user_series(spark, sf, users, **series).groupBy("user_id").agg(records.alias("financial_data"))


def queries(spark, sf) -> DataFrame:
    """Every benchmark text with a keyword in turn, and filters in turn."""
    n = F.col("item_id")
    keyword = F.get(F.array(*[F.lit(k) for k in KEYWORDS]), (n % len(KEYWORDS)).cast("int"))
    pair = lambda *kv: F.create_map(*[F.lit(x) for x in kv])
    filters = (
        F.when(n % 4 == 0, pair("lang", "en"))
        .when(n % 4 == 1, pair("date", "2024-06-01"))
        .when(n % 4 == 2, pair("source", "src1", "date", "2024-03-01"))
    )
    return table(spark, sf, "benchmark").select(
        n.alias("query_id"),
        F.concat_ws(" ", "text", keyword).alias("query"),
        filters.alias("filters"),
    )
