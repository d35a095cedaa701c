"""Column functions on queries, titles, reports and answers."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwell import fixed_values as fixed
from tickwell.functions.numbers import finite

# All but letters, numbers and blanks of any script.
NOT_WORD_OR_BLANK = r"[^\p{L}\p{N}\p{Z}\t-\r\x1c-\x1f\x{85}]"
BLANKS = r"[\p{Z}\t-\r\x1c-\x1f\x{85}]+"


def clean_query(query: Column) -> Column:
    return F.lower(F.regexp_replace(query, NOT_WORD_OR_BLANK, ""))


def _has_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def add_context(query: Column) -> Column:
    return F.when(
        _has_any(query, fixed.CONTEXT_TRIGGERS), F.concat(query, F.lit(fixed.CONTEXT_SUFFIX))
    ).otherwise(query)


def prepare_query(query: Column) -> Column:
    return add_context(clean_query(query))


def expand_query(prepared: Column) -> Column:
    """The prepared query with related terms; null when there are none."""
    terms = F.concat_ws(
        " ", *[F.when(prepared.contains(w), F.lit(t)) for w, t in fixed.EXPANSIONS.items()]
    )
    return F.when(terms != "", F.concat(prepared, F.lit(" "), terms))


def words(text: Column) -> Column:
    """Blank-separated parts of a text."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def first_words(text: Column, n: int) -> Column:
    """The first ``n`` words, without cutting the rest of the text into words."""
    parts = F.split(text, BLANKS, n + 2)
    return F.slice(F.filter(parts, lambda w: w != ""), 1, n)


def query_type(query: Column) -> Column:
    """The first type one of whose words occurs in the query."""
    lower = F.lower(query)
    found = [F.when(_has_any(lower, terms), name) for name, terms in fixed.QUERY_TYPES]
    return F.coalesce(*found, F.lit(fixed.OTHER_QUERY_TYPE))


def snippet(content: Column, n: int = fixed.SNIPPET_LENGTH) -> Column:
    return F.when(
        F.length(content) > n, F.concat(F.substring(content, 1, n), F.lit("..."))
    )


def percent(share: Column) -> Column:
    return F.concat(plain_money(share * 100), F.lit("%"))


def plain_money(value: Column) -> Column:
    """Two decimals without grouping."""
    return F.replace(F.format_number(value, 2), F.lit(","), F.lit(""))


def grouped_money(value: Column) -> Column:
    """Two decimals with grouping; ``nan`` where there is no value."""
    return F.coalesce(F.format_number(finite(value), 2), F.lit(fixed.NO_VALUE))


def fill(template: str, **columns: Column) -> Column:
    """A text with columns in place of the names in braces."""
    parts = re.split(r"\{(\w+)\}", template)
    filled = [columns[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if p]
    return F.concat(*filled)


def shown_time(moment: Column) -> Column:
    """Date and time; the fraction of a second only where there is one."""
    moment = moment.cast("timestamp")
    whole = F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_trunc("second", moment) == moment, whole).otherwise(
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def report_text() -> Column:
    """The text of a report from its columns."""
    shown = {c: _shown(F.col(c).cast("string")) for c in ("company_name", "cik", "fiscal_year")}
    moment = shown_time(F.col("filing_date"))
    return fill(
        fixed.REPORT_TEXT,
        **shown,
        filing_date=_shown(F.concat(moment, F.lit("+00:00"))),
        **{m: grouped_money(F.col(m).cast("double")) for m in fixed.CONCEPTS},
    )


def _shown(text: Column) -> Column:
    return F.coalesce(text, F.lit("None"))


def metric_title(metric: Column) -> Column:
    words = F.initcap(F.replace(metric, F.lit("_"), F.lit(" ")))
    return fill(fixed.LINE_CHART_TITLE, metric=words)


def chart_name(metric: Column) -> Column:
    return fill(fixed.LINE_CHART, metric=metric)


def chart_description(name: Column) -> Column:
    kind = F.element_at(F.split(name, "_"), -1)
    return fill(
        fixed.CHART_DESCRIPTION,
        name=name,
        kind=kind,
        words=F.replace(name, F.lit("_"), F.lit(" ")),
    )


def prompt(context: Column) -> Column:
    return F.concat(F.lit(fixed.PROMPT_HEAD), context, F.lit(fixed.PROMPT_TAIL))


def iso_time(text: Column) -> Column:
    """Time of an ISO 8601 text, null when it is none."""
    return text.try_cast("timestamp")


def age_days(moment: Column, as_of: Column) -> Column:
    """Whole days from ``moment`` to ``as_of``, rounded down."""
    day = 86_400_000_000
    return F.floor((F.unix_micros(as_of) - F.unix_micros(moment)) / day)


def recency(moment: Column, as_of: Column) -> Column:
    return F.coalesce(
        F.pow(F.lit(fixed.DAILY_DECAY), age_days(moment, as_of)), F.lit(fixed.NO_DATE_RECENCY)
    )


def freshness(newest: Column, as_of: Column) -> Column:
    age = age_days(newest, as_of)
    none = F.when(newest.isNull(), fixed.NO_DATES)
    young = [F.when(age < days, name) for name, days in fixed.FRESHNESS_DAYS]
    return F.coalesce(none, *young, F.lit(fixed.OLD_DATA))
