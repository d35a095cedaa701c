"""Prepared queries, hits with metadata, filters and re-ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell import fixed_values as fixed
from tickwell.functions import text as tx
from tickwell.operators.vectors import similar
from tickwell.session import stored

DATE = "date"


def prepare(queries: DataFrame, encode, query: str = "query") -> DataFrame:
    """Adds the prepared and, where there is one, the expanded text, each with
    its vector. ``encode`` turns a text column into a vector column."""
    texts = queries.withColumn("prepared", tx.prepare_query(F.col(query)))
    texts = texts.withColumn("expanded", tx.expand_query(F.col("prepared")))
    return texts.withColumns(
        {
            "embedding": encode(F.col("prepared")),
            "expanded_embedding": F.when(
                F.col("expanded").isNotNull(), encode(F.coalesce("expanded", F.lit("")))
            ),
        }
    )


def base_hits(
    docs: DataFrame,
    prepared: DataFrame,
    k: int | None = fixed.TOP_K,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
    dedupe: bool = False,
    **names,
) -> DataFrame:
    """Rows (query_id, id, similarity, place): the best ``k`` of each query and,
    where these are fewer than ``k``, the best of its expanded form for the
    missing number. A document may be found by both; ``dedupe`` keeps the first.

    Both forms are searched in the same pass over the documents.
    """
    k = k or fixed.TOP_K
    limit = [c for c in ("top_k",) if c in prepared.columns]
    forms = F.array(
        F.struct(F.lit(0).alias("form"), F.col("embedding").alias("vector")),
        F.struct(F.lit(1).alias("form"), F.col("expanded_embedding").alias("vector")),
    )
    versions = prepared.select("query_id", *limit, F.explode(forms).alias("f")).select(
        "query_id", *limit, "f.form", F.col("f.vector").alias("embedding")
    )
    hits = similar(docs, versions, k, threshold, query_vector="embedding", **names)
    per_query = Window.partitionBy("query_id")
    hits = hits.withColumn("_base", F.count(F.when(F.col("form") == 0, 1)).over(per_query))
    if limit:
        asked = prepared.select(
            "query_id", F.when(F.col("top_k") > 0, F.col("top_k")).otherwise(k).alias("_k")
        )
        hits = hits.join(asked, "query_id")
    else:
        hits = hits.withColumn("_k", F.lit(k))
    hits = hits.where((F.col("form") == 0) | (F.col("rank") <= F.col("_k") - F.col("_base")))
    place = F.row_number().over(per_query.orderBy("form", "rank"))
    hits = hits.withColumn("place", place)
    if dedupe:
        again = F.row_number().over(Window.partitionBy("query_id", "id").orderBy("place"))
        hits = hits.withColumn("_again", again).where(F.col("_again") == 1)
    return hits.select(
        "query_id", "id", "similarity", "place", (F.col("form") == 1).alias("by_expansion")
    )


def with_documents(hits: DataFrame, docs: DataFrame, *columns: str, id: str = "id") -> DataFrame:
    """Add document columns. The hits, at most 2 * k per query, are computed
    once; Spark sends them to the documents if their size allows."""
    table = docs.select(F.col(id).alias("_id"), *columns)
    return table.join(stored(hits), F.col("_id") == F.col("id")).drop("_id")


def _passes(metadata: Column, key: Column, value: Column) -> Column:
    found = metadata[key]
    date = tx.iso_time(found) >= tx.iso_time(value)
    return F.coalesce(F.when(key == DATE, date).otherwise(found == value), F.lit(False))


def matches(metadata: Column, filters: dict[str, str]) -> Column:
    """Whether all filters hold: equal values, and a date not before the given."""
    test = F.lit(True)
    for key, value in filters.items():
        test = test & _passes(metadata, F.lit(key), F.lit(value))
    return test


def matches_row(metadata: Column, filters: Column) -> Column:
    """The same with a map column of filters, one map per query."""
    return F.coalesce(
        F.forall(F.map_entries(filters), lambda f: _passes(metadata, f["key"], f["value"])),
        F.lit(True),
    )


def title_overlap(title: Column, prepared: Column) -> Column:
    """Number of different words that title and query share."""
    return F.size(
        F.array_intersect(tx.words(F.lower(title)), tx.words(F.lower(prepared)))
    )


def relevance(similarity: Column, title: Column, prepared: Column) -> Column:
    overlap = F.when(title.isNotNull(), title_overlap(title, prepared))
    bonus = F.coalesce(overlap * fixed.TITLE_TERM_BONUS, F.lit(0.0))
    return F.least(F.lit(1.0), F.coalesce(similarity, F.lit(0.0)) + bonus)


def rerank(hits: DataFrame, as_of: str) -> DataFrame:
    """Adds ``score`` and ``position``.

    Takes (query_id, prepared, similarity, place, metadata, ...). Among
    several hits the score weighs relevance and recency; a single hit keeps
    its similarity.
    """
    now = F.lit(as_of).cast("timestamp")
    metadata = F.col("metadata")
    per_query = Window.partitionBy("query_id")
    scored = hits.withColumns(
        {
            "relevance": relevance(F.col("similarity"), metadata["title"], F.col("prepared")),
            "recency": tx.recency(tx.iso_time(metadata[DATE]), now),
            "_hits": F.count(F.lit(1)).over(per_query),
        }
    )
    weighted = (
        fixed.RELEVANCE_WEIGHT * F.col("relevance") + fixed.RECENCY_WEIGHT * F.col("recency")
    )
    scored = scored.withColumn(
        "score", F.when(F.col("_hits") > 1, weighted).otherwise(F.col("similarity"))
    )
    order = per_query.orderBy(F.desc(F.round("score", 9)), "place")
    return scored.withColumn("position", F.row_number().over(order)).drop("_hits")


def retrieve(
    docs: DataFrame,
    prepared: DataFrame,
    as_of: str,
    k: int | None = fixed.TOP_K,
    threshold: float = fixed.SIMILARITY_THRESHOLD,
    filters: dict[str, str] | None = None,
    prefilter: bool = False,
    dedupe: bool = False,
    keep_columns: tuple[str, ...] = (),
    **names,
) -> DataFrame:
    """The whole retrieval: search, expansion, filters, re-ranking, snippets.

    Filters apply to the hits found, so fewer than ``k`` may remain; with
    ``prefilter`` the fixed filters apply to the documents before the search.
    A map column ``filters`` of ``prepared`` holds filters of single queries.
    """
    if prefilter and filters:
        docs = docs.where(matches(F.col("metadata"), filters))
    hits = base_hits(docs, prepared, k, threshold, dedupe, **names)
    hits = with_documents(hits, docs, "content", "metadata", *keep_columns)
    extra = [c for c in ("query", "filters") if c in prepared.columns]
    hits = hits.join(prepared.select("query_id", "prepared", *extra), "query_id")
    if filters and not prefilter:
        hits = hits.where(matches(F.col("metadata"), filters))
    if "filters" in extra:
        hits = hits.where(matches_row(F.col("metadata"), F.col("filters"))).drop("filters")
    return rerank(hits, as_of).withColumn("snippet", tx.snippet(F.col("content")))
