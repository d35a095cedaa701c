"""One answer context per query, from the hits and the series attached to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell import fixed_values as fixed
from tickwell.functions import text as tx
from tickwell.operators.bars import auto_bars, resample
from tickwell.operators.stats import price_range
from tickwell.schema import OHLCV
from tickwell.session import stored

SOURCES = "array<struct<title: string, date: string, source: string, relevance: string>>"


def has_ohlcv_fields(fields: Column) -> Column:
    wanted = F.array(*[F.lit(c) for c in OHLCV])
    return F.size(F.array_intersect(F.map_keys(fields), wanted)) == len(OHLCV)


def classify(records: DataFrame, by: str = "query_id") -> DataFrame:
    """Whether all records of a collection have the five OHLCV fields."""
    return records.groupBy(by).agg(
        F.bool_and(has_ohlcv_fields(F.col("fields"))).alias("is_ohlcv"),
        F.count(F.lit(1)).alias("records"),
    )


def charts(classes: DataFrame, records: DataFrame, by: str = "query_id") -> DataFrame:
    """Rows (query, place, name, title): price and indicator charts for OHLCV
    data, else one line chart per metric."""
    named = [
        F.struct(F.lit(n).alias("name"), F.lit(t).alias("title"))
        for n, t in fixed.OHLCV_CHARTS.items()
    ]
    ohlcv = classes.where("is_ohlcv").select(by, F.posexplode(F.array(*named)).alias("place", "c"))
    metrics = metric_names(records, by).join(classes.where("not is_ohlcv").select(by), by)
    lines = metrics.select(by, F.posexplode("metrics").alias("place", "metric")).select(
        by,
        "place",
        tx.chart_name(F.col("metric")).alias("name"),
        tx.metric_title(F.col("metric")).alias("title"),
    )
    return ohlcv.select(by, "place", "c.*").unionByName(lines)


def metric_names(records: DataFrame, by: str = "query_id") -> DataFrame:
    """The names of the fields of a collection in order of first appearance."""
    names = records.select(by, "row_id", F.posexplode(F.map_keys("fields")).alias("pos", "name"))
    first = names.groupBy(by, "name").agg(F.min(F.struct("row_id", "pos")).alias("first"))
    return first.groupBy(by).agg(
        F.array_sort(F.collect_list(F.struct("first", "name")))["name"].alias("metrics")
    )


def summaries(records: DataFrame, classes: DataFrame, points: int = fixed.MAX_POINTS) -> DataFrame:
    """One line of text about the series of each query."""
    kinds = records.join(classes.select("query_id", "is_ohlcv"), "query_id")
    rows = kinds.where("is_ohlcv").select(
        "query_id", "ts", "row_id", *[F.col("fields")[c].alias(c) for c in OHLCV]
    )
    ranges = price_range(auto_bars(rows, by=["query_id"], points=points), by=["query_id"])
    price_text = tx.fill(
        fixed.PRICE_SUMMARY,
        first=tx.shown_time(F.col("first_date")),
        last=tx.shown_time(F.col("last_date")),
        low=tx.plain_money(F.col("low_close")),
        high=tx.plain_money(F.col("high_close")),
    )
    price = ranges.select("query_id", price_text.alias("summary"))
    generic = kinds.where("not is_ohlcv")
    # Only the times matter for the text, so one constant column stands for all.
    times = generic.select("query_id", "ts", "row_id", F.lit(0.0).alias("v"))
    dates = resample(times, "max", ["v"], by=["query_id"], points=points)
    dates = dates.groupBy("query_id").agg(
        F.min("ts").alias("first_date"), F.max("ts").alias("last_date")
    )
    series_text = tx.fill(
        fixed.SERIES_SUMMARY,
        metrics=F.array_join("metrics", ", "),
        first=tx.shown_time(F.col("first_date")),
        last=tx.shown_time(F.col("last_date")),
    )
    other = dates.join(metric_names(generic), "query_id").select(
        "query_id", series_text.alias("summary")
    )
    return price.unionByName(other)


def in_order(place: str, value: Column, separator: str) -> Column:
    """Aggregate: the values joined in the order of ``place``; for groups of
    limited size, such as the hits of a query."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), value.alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), separator)


def source_record(metadata: Column, similarity: Column) -> Column:
    named = [F.coalesce(metadata[k], F.lit(v)).alias(k) for k, v in fixed.SOURCE_DEFAULTS.items()]
    relevance = tx.percent(F.coalesce(similarity, F.lit(0.0)))
    return F.struct(*named, relevance.alias("relevance"))


def newest_dates(hits: DataFrame, as_of: str) -> DataFrame:
    """Newest date among the hits of a query and how fresh it is."""
    now = F.lit(as_of).cast("timestamp")
    newest = hits.groupBy("query_id").agg(
        F.max(tx.iso_time(F.col("metadata")["date"])).alias("newest")
    )
    return newest.withColumn("freshness", tx.freshness(F.col("newest"), now))


def _of_query(hits: DataFrame) -> DataFrame:
    """(query_id, hits, records): one row per query with all its context needs.

    A query has few hits, at most twice the depth of the search, and a hit
    brings its records in one array, so a row holds what its hits held.
    """
    columns = ("position", "content", "metadata", "similarity", "financial_data")
    by_position = lambda x, y: (x["position"] - y["position"]).cast("int")
    rows = hits.groupBy("query_id").agg(F.collect_list(F.struct(*columns)).alias("hits"))
    rows = rows.withColumn("hits", F.array_sort("hits", by_position))
    none = F.array().cast(hits.schema["financial_data"].dataType)
    series = F.transform("hits", lambda h: F.coalesce(h["financial_data"], none))
    return rows.select(
        "query_id",
        F.transform("hits", lambda h: F.struct(*[h[c].alias(c) for c in columns[1:-1]])).alias("hits"),
        F.flatten(series).alias("records"),
    )


def _summary(names: str, points: int) -> Column:
    """The text of ``summaries`` from an array of records; null where it has to be resampled."""
    times = F.transform("records", lambda r: r["ts"])
    span = {"first": tx.shown_time(F.array_min(times)), "last": tx.shown_time(F.array_max(times))}
    closes = F.transform("records", lambda r: r["fields"]["close"])
    price = tx.fill(
        fixed.PRICE_SUMMARY,
        **span,
        low=tx.plain_money(F.array_min(closes)),
        high=tx.plain_money(F.array_max(closes)),
    )
    series = tx.fill(fixed.SERIES_SUMMARY, metrics=F.array_join(names, ", "), **span)
    text = F.when(F.col("is_ohlcv"), price).when(~F.col("is_ohlcv") & (F.size(names) > 0), series)
    return F.when(F.size("records") <= points, text)


def answer_contexts(queries: DataFrame, hits: DataFrame, as_of: str, points: int = fixed.MAX_POINTS) -> DataFrame:
    """One row per query: context, prompt, charts, sources and metadata.

    ``hits`` come from ``retrieve`` and carry ``financial_data``. Queries
    without hits get a context of the query alone. Hits and records of a query
    come together in one grouping, and all texts are made from its row; only
    series of more than ``points`` records are taken out of it, to be
    resampled as tables.
    """
    table = stored(_of_query(hits))
    fields = F.transform("records", lambda r: F.coalesce(F.map_keys(r["fields"]), F.array().cast("array<string>")))
    kinds = F.transform("records", lambda r: has_ohlcv_fields(r["fields"]))
    found = table.withColumns({"is_ohlcv": F.array_min(kinds), "names": F.array_distinct(F.flatten(fields))})
    found = found.withColumn("summary", _summary("names", points))
    large = table.where(F.size("records") > points)
    if not large.isEmpty():
        rows = large.select("query_id", F.posexplode("records").alias("pos", "record"))
        rows = rows.select("query_id", "record.ts", F.col("pos").cast("bigint").alias("row_id"), "record.fields")
        texts = summaries(rows, classify(rows), points).withColumnRenamed("summary", "_text")
        found = found.join(texts, "query_id", "left").withColumn("summary", F.coalesce("summary", "_text"))
    drawn = F.when(F.col("is_ohlcv"), F.array(*map(F.lit, fixed.OHLCV_CHARTS))).when(
        ~F.col("is_ohlcv") & (F.size("names") > 0), F.transform("names", tx.chart_name)
    )
    now = F.lit(as_of).cast("timestamp")
    newest = F.array_max(F.transform("hits", lambda h: tx.iso_time(h["metadata"]["date"])))
    found = found.withColumn("drawn", drawn).select(
        "query_id",
        "summary",
        F.array_join(F.transform("hits", lambda h: h["content"]), "\n").alias("contents"),
        F.transform("hits", lambda h: source_record(h["metadata"], h["similarity"])).alias("sources"),
        F.array_join(F.transform("drawn", tx.chart_description), "\n").alias("charts"),
        F.array_sort("drawn").alias("visualizations"),
        tx.freshness(newest, now).alias("freshness"),
    )
    table = queries.select("query_id", "query").join(found, "query_id", "left")

    def section(heading: str, body: str) -> Column:
        return F.when(F.col(body).isNotNull(), F.concat(F.lit(heading + "\n"), F.col(body)))

    context = F.concat_ws(
        "\n",
        F.lit(fixed.RETRIEVED_HEADING),
        F.col("contents"),
        section(fixed.SERIES_HEADING, "summary"),
        section(fixed.CHARTS_HEADING, "charts"),
        F.concat(F.lit(fixed.QUERY_HEADING), F.col("query")),
    )
    table = table.withColumn("context", context)
    return table.select(
        "query_id",
        "context",
        tx.prompt(F.col("context")).alias("prompt"),
        "visualizations",
        F.coalesce("sources", F.array().cast(SOURCES)).alias("sources"),
        F.lit(as_of).alias("timestamp"),
        tx.query_type(F.col("query")).alias("query_type"),
        F.coalesce("freshness", F.lit(fixed.NO_DATES)).alias("data_freshness"),
    )
