"""The same queries in SQL over the same tables."""

from __future__ import annotations

from tickwell.fixed_values import PROMPT_HEAD, PROMPT_TAIL
from workload.adapters import AS_OF, KEYWORDS
from workload.queries import LABEL_THRESHOLD, METRIC_LIMIT, THRESHOLD

METRICS = ["revenue", "net_income", "total_assets", "total_liabilities", "operating_cash_flow"]
RATIOS = ["current_ratio", "profit_margin"]
OHLCV = ["open", "high", "low", "close", "volume"]


def rnd(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


def rnds(*names: str) -> str:
    return ", ".join(rnd(n) for n in names)


TICKS = """ticks AS (
  SELECT event_type AS symbol, ts, event_id AS row_id, value AS close,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
  FROM events)"""
DAILY = """daily AS (
  SELECT o_orderpriority AS symbol, o_orderdate AS ts, o_orderkey AS row_id,
         o_totalprice AS price,
         CASE WHEN o_orderstatus <> 'P' THEN sqrt(o_totalprice) END AS settled
  FROM orders)"""

# ---- Bars -------------------------------------------------------------------


def ohlcv(price: str, volume: str) -> str:
    return f"""arg_min({price}, (ts, row_id)) FILTER ({price} IS NOT NULL) AS open,
      max({price}) AS high, min({price}) AS low,
      arg_max({price}, (ts, row_id)) FILTER ({price} IS NOT NULL) AS close,
      coalesce(sum({volume}), 0.0) AS volume"""


HOURLY = f"""{TICKS}, hourly AS (
  SELECT symbol, date_trunc('hour', ts) AS ts, {ohlcv('close', 'volume')}
  FROM ticks GROUP BY 1, 2)"""
HOURLY_GRID = f"""{HOURLY}, hours AS (
  SELECT symbol, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts
  FROM hourly GROUP BY symbol),
grid AS (
  SELECT h.symbol, h.ts, b.open, b.high, b.low, b.close, coalesce(b.volume, 0.0) AS volume
  FROM hours h LEFT JOIN hourly b ON h.symbol = b.symbol AND h.ts = b.ts)"""


def bucketed(rows: str, points: int, weekly: bool) -> str:
    """CTEs spans, placed (rows with label) and labels (all labels)."""
    day = 86400000000
    week = 7 * day
    days = f"greatest(1, floor(floor(d / {day}) / {points})) * {day}"
    weeks = f"greatest(1, floor(floor(floor(d / {day}) / 7) / {points})) * {week}"
    last = f"WHEN d < {4 * week} THEN {days} ELSE {weeks}" if weekly else f"ELSE {days}"
    by_start = "o + floor((us - o) / w) * w"
    sunday = "epoch_us(date_trunc('week', make_timestamp({0})) + INTERVAL 6 DAY)"
    label = by_start
    if weekly:
        s_us, s_f = sunday.format("us"), sunday.format("f")
        by_end = f"{s_f} + ceil(({s_us} - {s_f}) / w) * w"
        label = f"CASE WHEN w >= {week} THEN {by_end} ELSE {by_start} END"
    return f"""ends AS (
  SELECT symbol, min(epoch_us(ts)) AS f, max(epoch_us(ts)) AS l, count(*) AS n
  FROM {rows} GROUP BY symbol),
spans AS (
  SELECT symbol, f, l, n, floor(f / {day}) * {day} AS o,
    CAST(CASE WHEN d < 3600000000 THEN greatest(1, floor(d / 1000000 / {points})) * 1000000
         WHEN d < {day} THEN greatest(1, floor(d / 3600000000 / {points})) * 3600000000
         {last} END AS BIGINT) AS w
  FROM (SELECT *, l - f AS d FROM ends)),
placed AS (
  SELECT r.*, s.n > {points} AS many,
    CAST(CASE WHEN s.n > {points} THEN {label} ELSE us END AS BIGINT) AS label,
    CASE WHEN s.n <= {points} THEN row_id END AS own
  FROM (SELECT *, epoch_us(ts) AS us FROM {rows}) r JOIN spans s ON r.symbol = s.symbol),
labels AS (
  SELECT symbol, unnest(generate_series(
    CAST({label.replace('us', 'f') if not weekly else label.replace('(us)', '(f)').replace('(us - o)', '(f - o)')} AS BIGINT),
    CAST({label.replace('us', 'l') if not weekly else label.replace('make_timestamp(us)', 'make_timestamp(l)').replace('(us - o)', '(l - o)')} AS BIGINT),
    w)) AS label
  FROM (SELECT *, 0 AS us FROM spans) WHERE n > {points})"""


def resampled(rows: str, columns: str, names: list[str], zero: list[str], points: int, weekly: bool):
    values = ", ".join(f"coalesce(a.{c}, 0.0) AS {c}" if c in zero else f"a.{c}" for c in names)
    own = ", ".join(names)
    return f"""{bucketed(rows, points, weekly)},
merged AS (
  SELECT symbol, label, own, many, {columns} FROM placed GROUP BY symbol, label, own, many),
final AS (
  SELECT symbol, make_timestamp(label) AS ts, own AS row_id, {own} FROM merged WHERE NOT many
  UNION ALL
  SELECT g.symbol, make_timestamp(g.label) AS ts, g.label AS row_id, {values}
  FROM labels g LEFT JOIN (SELECT * FROM merged WHERE many) a
    ON g.symbol = a.symbol AND g.label = a.label)"""


AUTO_BARS = f"{TICKS}, " + resampled(
    "ticks", ohlcv("close", "volume"), OHLCV, ["volume"], 1000, False
)
AUTO_DAILY = f"{DAILY}, " + resampled(
    "daily", ohlcv("price", "settled"), OHLCV, ["volume"], 1000, False
)


def exact_mean(value: str, digits: int) -> str:
    """Mean of numbers with so many digits as a whole number of units four digits finer, halves up."""
    total = f"sum(CAST(round({value} * 1e{digits}) AS HUGEINT))"
    return f"((2 * {total} * 10000 + count({value})) // (2 * count({value})))"


def resample(aggregation: str, points: int) -> str:
    how = {"mean": "avg"}.get(aggregation, aggregation)
    columns = ", ".join(f"CAST({how}({v}) AS DOUBLE) AS {v}" for v in ("price", "settled"))
    if aggregation == "mean":
        columns = f"CAST({exact_mean('price', 2)} AS DOUBLE) / 1e6 AS price, avg(settled) AS settled"
    zero = ["price", "settled"] if aggregation == "sum" else []
    return f"{DAILY}, " + resampled(
        "daily", columns, ["price", "settled"], zero, points, True
    )


# ---- Indicators -------------------------------------------------------------

W = "PARTITION BY symbol ORDER BY ts, row_id"


def last(n: int) -> str:
    return f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def rolling(how: str, column: str, n: int) -> str:
    return f"CASE WHEN count({column}) {last(n)} = {n} THEN {how}({column}) {last(n)} END"


AVERAGES = ", ".join(rnd(rolling("avg", "close", n), f"ma{n}") for n in (5, 10, 20, 50))
MIDDLE, SPREAD = rolling("avg", "close", 20), f"2 * ({rolling('stddev_samp', 'close', 20)})"
BANDS = ", ".join(
    [
        rnd(f"({MIDDLE}) + ({SPREAD})", "bb_upper"),
        rnd(f"({MIDDLE}) - ({SPREAD})", "bb_lower"),
        rnd(MIDDLE, "bb_middle"),
    ]
)


def rsi_ctes(rows: str) -> str:
    return f"""changes AS (
  SELECT *, close - lag(close) OVER ({W}) AS change FROM {rows}),
moves AS (
  SELECT *, CASE WHEN change > 0 THEN change ELSE 0.0 END AS gain,
         CASE WHEN change < 0 THEN -change ELSE 0.0 END AS loss FROM changes),
strength AS (
  SELECT *, {rolling('sum', 'gain', 14)} AS up, {rolling('sum', 'loss', 14)} AS down FROM moves),
relative AS (
  SELECT *, CASE WHEN down = 0 AND up > 0 THEN 100.0
    ELSE 100 - 100 / (1 + up / nullif(down, 0)) END AS rsi FROM strength)"""


def macd_ctes(rows: str) -> str:
    """Row by row: the old weight fades with every row, a value resets it."""

    def step(y: str, wt: str, x: str, span: int) -> tuple[str, str]:
        a = 2.0 / (span + 1)
        old = f"({wt} * {1 - a!r}::DOUBLE)"
        value = (
            f"CASE WHEN {x} IS NULL THEN {y} WHEN {y} IS NULL THEN {x} "
            f"ELSE ({old} * {y} + {a!r}::DOUBLE * {x}) / ({old} + {a!r}::DOUBLE) END"
        )
        return value, f"CASE WHEN {x} IS NULL THEN {old} ELSE 1.0::DOUBLE END"

    fast, fast_w = step("e.fast", "e.fast_w", "r.close", 12)
    slow, slow_w = step("e.slow", "e.slow_w", "r.close", 26)
    sig, sig_w = step("g.sig", "g.sig_w", "r.macd", 9)
    return f"""numbered AS (
  SELECT *, row_number() OVER ({W}) AS rn FROM {rows}),
e AS (
  SELECT symbol, rn, close AS fast, 1.0::DOUBLE AS fast_w, close AS slow, 1.0::DOUBLE AS slow_w
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT r.symbol, r.rn, {fast}, {fast_w}, {slow}, {slow_w}
  FROM e JOIN numbered r ON r.symbol = e.symbol AND r.rn = e.rn + 1),
lines AS (SELECT symbol, rn, fast, slow, fast - slow AS macd FROM e),
g AS (
  SELECT symbol, rn, macd AS sig, 1.0::DOUBLE AS sig_w FROM lines WHERE rn = 1
  UNION ALL
  SELECT r.symbol, r.rn, {sig}, {sig_w}
  FROM g JOIN lines r ON r.symbol = g.symbol AND r.rn = g.rn + 1),
converging AS (
  SELECT n.*, l.fast AS ema_fast, l.slow AS ema_slow, l.macd, g.sig AS macd_signal,
         l.macd - g.sig AS macd_histogram
  FROM numbered n JOIN lines l ON n.symbol = l.symbol AND n.rn = l.rn
  JOIN g ON n.symbol = g.symbol AND n.rn = g.rn)"""


MACD_NAMES = ["ema_fast", "ema_slow", "macd", "macd_signal", "macd_histogram"]
MACD_COLUMNS = ", ".join(rnd(n, digits=4) for n in MACD_NAMES)


def returns_ctes(rows: str) -> str:
    return f"""filled AS (
  SELECT *, last_value(close IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fill,
    lag(close) OVER ({W}) AS before FROM {rows}),
earned AS (
  SELECT *, fill / nullif(lag(fill) OVER ({W}), 0) - 1 AS simple_return,
    CASE WHEN close / nullif(before, 0) > 0 THEN ln(close / nullif(before, 0)) END AS log_return
  FROM filled)"""


STATS = f"""SELECT symbol, min(ts) AS start_date, max(ts) AS end_date, count(*) AS trading_days,
  {rnd("arg_max(close, (ts, row_id))", "current_price")},
  {rnd("coalesce(sum(volume), 0.0)", "volume_total")}, {rnd("avg(volume)", "volume_avg")},
  {rnd("max(high)", "high")}, {rnd("min(low)", "low")},
  {rnd("avg(close)", "mean")}, {rnd("stddev_samp(close)", "std")},
  {rnd("(arg_max(close, (ts, row_id)) / nullif(arg_min(close, (ts, row_id)), 0) - 1) * 100", "total_return")},
  {rnd("avg(simple_return) * 100", "daily_returns_mean")},
  {rnd("stddev_samp(simple_return) * 100", "daily_returns_std")},
  {rnd("avg(simple_return) / nullif(stddev_samp(simple_return), 0) * sqrt(252)", "sharpe_ratio")},
  {rnd("stddev_samp(log_return) * sqrt(252) * 100", "volatility_annualized")}
FROM earned GROUP BY symbol"""

# ---- Reports ----------------------------------------------------------------

METRICS_CTE = """yearly AS (
  SELECT o_custkey AS custkey, year(o_orderdate) AS fiscal_year,
    CAST(sum(p) AS DOUBLE) AS revenue,
    CAST(sum(p * (CAST(0.01 AS DECIMAL(18,2)) + t - d)) AS DOUBLE) AS net_income,
    CAST(sum(p * (1 + t)) AS DOUBLE) AS total_assets,
    coalesce(CAST(sum(CASE WHEN l_returnflag = 'R' THEN p END) AS DOUBLE), 0.0) AS total_liabilities,
    CAST(sum(CASE WHEN l_linestatus = 'F' THEN p * (1 - d) END) AS DOUBLE) AS operating_cash_flow
  FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_tax AS DECIMAL(18,2)) AS t,
               CAST(l_discount AS DECIMAL(18,2)) AS d FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2),
yearly_facts AS (
  SELECT lpad(CAST(custkey AS VARCHAR), 10, '0') AS cik, CAST(fiscal_year AS INTEGER) AS fiscal_year,
    revenue, net_income, total_assets, total_liabilities, operating_cash_flow,
    operating_cash_flow IS NOT NULL AS has_facts, custkey
  FROM yearly)"""
REPORTS = f"""{METRICS_CTE}, reports AS (
  SELECT cik,
    CASE WHEN coalesce(c_acctbal < 0, true) THEN 'Company ' || cik
         WHEN c_mktsegment = 'MACHINERY' THEN 'Unknown' ELSE c_name END AS company_name,
    '10-K' AS filing_type, TIMESTAMP '{AS_OF}' AS filing_date, fiscal_year, 'FY' AS fiscal_period,
    {', '.join(METRICS)},
    total_assets / nullif(total_liabilities, 0) AS current_ratio,
    net_income / nullif(revenue, 0) AS profit_margin
  FROM yearly_facts LEFT JOIN customer ON custkey = c_custkey
  WHERE has_facts)"""


def _shown(metric: str) -> str:
    return f"'$' || coalesce(format('{{:,.2f}}', {metric}), 'nan')"


_INDENT = "E'\\n        '"
REPORT_TEXT = " || ".join(
    [
        f"{_INDENT} || 'Financial Report for ' || company_name || ' (CIK: ' || cik || ')'",
        f"{_INDENT} || 'Filing Date: {AS_OF}+00:00'",
        f"{_INDENT} || 'Fiscal Year: ' || CAST(fiscal_year AS VARCHAR)",
        f"{_INDENT}",
        f"{_INDENT} || 'Key Financial Metrics:'",
        f"{_INDENT} || '- Revenue: ' || {_shown('revenue')}",
        f"{_INDENT} || '- Net Income: ' || {_shown('net_income')}",
        f"{_INDENT} || '- Total Assets: ' || {_shown('total_assets')}",
        f"{_INDENT} || '- Total Liabilities: ' || {_shown('total_liabilities')}",
        f"{_INDENT} || '- Operating Cash Flow: ' || {_shown('operating_cash_flow')}",
        f"{_INDENT}",
    ]
)

DIRECTORY = """SELECT CAST(floor(c_custkey / 100) AS BIGINT) AS file,
  CAST(row_number() OVER (PARTITION BY floor(c_custkey / 100) ORDER BY c_custkey) - 1 AS INTEGER) AS pos,
  lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik,
  'T' || CAST(c_custkey AS VARCHAR) AS ticker, c_name AS title
FROM customer"""

# ---- Text and vectors -------------------------------------------------------

NOT_WORD = r"[^\p{L}\p{N}\p{Z}\t-\r\x1c-\x1f\x{85}]"
BLANKS = r"[\p{Z}\t-\r\x1c-\x1f\x{85}]+"


def clean(text: str) -> str:
    return f"lower(regexp_replace({text}, '{NOT_WORD}', '', 'g'))"


def words(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{BLANKS}'), lambda w: w <> '')"


def has_any(text: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{t}')" for t in terms) + ")"


def keyword(number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(KEYWORDS))
    return f"(CASE {number} % {len(KEYWORDS)} {cases} END)"


PREPARED = (
    "CASE WHEN " + has_any("cleaned", ["stock", "price", "market"])
    + " THEN cleaned || ' financial market analysis' ELSE cleaned END"
)
EXPANDED = """CASE WHEN contains(prepared, 'stock') AND contains(prepared, 'price')
    THEN prepared || ' equity shares value cost'
  WHEN contains(prepared, 'stock') THEN prepared || ' equity shares'
  WHEN contains(prepared, 'price') THEN prepared || ' value cost' END"""
QUERY_TYPE = (
    "CASE WHEN " + has_any("lower(query)", ["price", "stock", "ohlc", "candlestick"])
    + " THEN 'price_analysis' WHEN " + has_any("lower(query)", ["trend", "compare", "correlation"])
    + " THEN 'trend_analysis' WHEN " + has_any("lower(query)", ["forecast", "predict", "future"])
    + " THEN 'prediction' ELSE 'general_analysis' END"
)
SPOKEN = f"""spoken AS (
  SELECT conv_id, turn, text || ' ' || {keyword('(conv_id + turn)')} AS query FROM conversations),
ready AS (
  SELECT *, {PREPARED} AS prepared FROM (SELECT *, {clean('query')} AS cleaned FROM spoken))"""


def buckets(rows: str, id: str, text: str, name: str) -> str:
    """CTE with the unit vector of each text, one row per bucket in use."""
    return f"""{name}_counts AS (
  SELECT {id} AS id, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 384 AS bucket, count(*) AS n
  FROM (SELECT {id}, unnest({words(clean(text))}) AS token FROM {rows}) GROUP BY 1, 2),
{name} AS (
  SELECT id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS weight FROM {name}_counts)"""


DOCS = f"""docs AS (
  SELECT doc_id AS id, text AS content, lang, source,
    array_to_string(list_slice({words('text')}, 1, 5), ' ') AS title,
    CASE WHEN doc_id % 7 <> 3 THEN DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) END AS day
  FROM documents)"""
QUERIES = f"""queries AS (
  SELECT item_id AS query_id, text || ' ' || {keyword('item_id')} AS query FROM benchmark),
prepared AS (
  SELECT *, {EXPANDED} AS expanded FROM (
    SELECT *, {PREPARED} AS prepared FROM (
      SELECT *, {clean('query')} AS cleaned FROM queries)))"""

def hits(docs: str = DOCS, k: str = "5") -> str:
    """Hits of both forms of each query; ``k`` may depend on query_id."""
    return f"""{docs}, {QUERIES},
forms AS (
  SELECT query_id * 2 AS key, prepared AS body FROM prepared
  UNION ALL
  SELECT query_id * 2 + 1, expanded FROM prepared WHERE expanded IS NOT NULL),
{buckets('docs', 'id', 'content', 'dv')},
{buckets('forms', 'key', 'body', 'qv')},
pairs AS (
  SELECT q.id AS key, d.id, sum(q.weight * d.weight) AS similarity
  FROM qv q JOIN dv d ON q.bucket = d.bucket GROUP BY 1, 2),
placed AS (
  SELECT key // 2 AS query_id, key % 2 AS form, id, similarity,
    row_number() OVER (PARTITION BY key ORDER BY round(similarity, 9) DESC, id) AS rank
  FROM pairs WHERE similarity > {THRESHOLD}),
base AS (SELECT query_id, least(count(*), any_value({k})) AS n FROM placed WHERE form = 0 GROUP BY 1),
hits AS (
  SELECT p.query_id, p.id, p.similarity, p.form = 1 AS by_expansion,
    row_number() OVER (PARTITION BY p.query_id ORDER BY form, rank) AS place
  FROM placed p LEFT JOIN base b ON p.query_id = b.query_id
  WHERE CASE WHEN form = 0 THEN rank <= {k.replace('query_id', 'p.query_id')} ELSE rank <= {k.replace('query_id', 'p.query_id')} - coalesce(b.n, 0) END)"""


HITS = hits()
FOUND = f"""{HITS}, found AS (
  SELECT h.*, d.content, d.title, d.lang, d.source, d.day, q.query, q.prepared
  FROM hits h JOIN docs d ON h.id = d.id JOIN prepared q ON h.query_id = q.query_id)"""
FILTERED = f"""{FOUND}, chosen AS (
  SELECT * FROM found WHERE CASE query_id % 4
    WHEN 0 THEN lang = 'en'
    WHEN 1 THEN coalesce(day >= DATE '2024-06-01', false)
    WHEN 2 THEN source = 'src1' AND coalesce(day >= DATE '2024-03-01', false)
    ELSE true END)"""


def scored(rows: str) -> str:
    return f"""marked AS (
  SELECT *, least(1.0, similarity + 0.1 * len(list_intersect(
      list_distinct({words('lower(title)')}), list_distinct({words('lower(prepared)')})))) AS relevance,
    coalesce(pow(0.99, floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(CAST(day AS TIMESTAMP))) / 86400000000)), 0.5) AS recency,
    count(*) OVER (PARTITION BY query_id) AS c
  FROM {rows}),
weighed AS (
  SELECT *, CASE WHEN c > 1 THEN 0.7 * relevance + 0.3 * recency ELSE similarity END AS score FROM marked),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, place) AS INTEGER) AS position
  FROM weighed)"""


AGE = f"floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(CAST(newest AS TIMESTAMP))) / 86400000000)"
FRESHNESS = f"""CASE WHEN newest IS NULL THEN 'unknown' WHEN {AGE} < 1 THEN 'very_fresh'
  WHEN {AGE} < 7 THEN 'fresh' WHEN {AGE} < 30 THEN 'recent' ELSE 'historical' END"""

USER_DAYS = f"""user_ticks AS (
  SELECT user_id, ts, event_id AS row_id, value AS close,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume FROM events),
user_days AS (
  SELECT user_id, date_trunc('day', ts) AS ts, user_id % 3 <> 0 AS full_bar, {ohlcv('close', 'volume')}
  FROM user_ticks GROUP BY user_id, date_trunc('day', ts))"""

# A collection is shown from its resampled rows; as no query has more than a
# thousand daily records, these are the records themselves.
DAILY_CLASSES = f"""{USER_DAYS},
records AS (
  SELECT r.query_id, r.position, u.* FROM ranked r JOIN user_days u ON r.id = u.user_id),
classes AS (
  SELECT query_id, bool_and(full_bar) AS is_ohlcv, min(ts) AS first_date, max(ts) AS last_date,
    min(close) AS low_close, max(close) AS high_close, bool_or(full_bar) AS any_volume
  FROM records GROUP BY query_id)"""

# Hourly records of a tenth of all users per hit: thousands for most queries.
HOURLY_CLASSES = f"""{USER_DAYS},
crew_hours AS (
  SELECT user_id % 10 AS crew, date_trunc('hour', ts) AS ts, (user_id % 10) % 3 <> 0 AS full_bar, {ohlcv('close', 'volume')}
  FROM user_ticks GROUP BY user_id % 10, date_trunc('hour', ts)),
records AS (
  SELECT r.query_id, row_number() OVER (PARTITION BY r.query_id ORDER BY r.position, c.ts) - 1 AS row_id, c.*
  FROM ranked r JOIN crew_hours c ON r.id % 10 = c.crew),
kinds AS (
  SELECT query_id, bool_and(full_bar) AS is_ohlcv, bool_or(full_bar) AS any_volume FROM records GROUP BY query_id),
price_rows AS (
  SELECT query_id AS symbol, ts, row_id, close, volume FROM records JOIN kinds USING (query_id) WHERE is_ohlcv),
time_rows AS (
  SELECT query_id AS symbol, ts, row_id, 0.0 AS v FROM records JOIN kinds USING (query_id) WHERE NOT is_ohlcv),
price_spans AS (
  SELECT symbol, min(ts) AS f, max(ts) AS l, min(close) AS low, max(close) AS high
  FROM (WITH {resampled('price_rows', ohlcv('close', 'volume'), OHLCV, ['volume'], 1000, False)} SELECT * FROM final)
  GROUP BY symbol),
time_spans AS (
  SELECT symbol, min(ts) AS f, max(ts) AS l
  FROM (WITH {resampled('time_rows', 'max(v) AS v', ['v'], [], 1000, True)} SELECT * FROM final)
  GROUP BY symbol),
classes AS (
  SELECT k.*, coalesce(p.f, t.f) AS first_date, coalesce(p.l, t.l) AS last_date, p.low AS low_close, p.high AS high_close
  FROM kinds k LEFT JOIN price_spans p ON p.symbol = k.query_id LEFT JOIN time_spans t ON t.symbol = k.query_id)"""


def context(classes: str) -> str:
    return f"""{FILTERED}, {scored('chosen')}, {classes},
texts AS (
  SELECT query_id,
    CASE WHEN is_ohlcv THEN 'Price data available from ' || strftime(first_date, '%Y-%m-%d %H:%M:%S')
        || ' to ' || strftime(last_date, '%Y-%m-%d %H:%M:%S') || '. Price range: $'
        || format('{{:.2f}}', low_close) || ' - $' || format('{{:.2f}}', high_close)
      ELSE 'Time series data for open, high, low, close' || CASE WHEN any_volume THEN ', volume' ELSE '' END
        || ' from ' || strftime(first_date, '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(last_date, '%Y-%m-%d %H:%M:%S') END AS summary,
    CASE WHEN is_ohlcv THEN ['price_chart', 'technical_indicators']
      WHEN any_volume THEN ['open_chart', 'high_chart', 'low_chart', 'close_chart', 'volume_chart']
      ELSE ['open_chart', 'high_chart', 'low_chart', 'close_chart'] END AS names
  FROM classes),
grouped AS (
  SELECT query_id, string_agg(content, E'\\n' ORDER BY position) AS contents,
    string_agg(title || '|' || coalesce(CAST(day AS VARCHAR), 'Unknown date') || '|' || source || '|'
      || format('{{:.2f}}', similarity * 100) || '%', ';' ORDER BY position) AS sources,
    max(day) AS newest
  FROM ranked GROUP BY query_id),
joined AS (
  SELECT q.query_id, q.query, g.contents, g.sources, g.newest, t.summary, t.names,
    concat_ws(E'\\n', 'Retrieved Information:', g.contents,
      E'\\nFinancial Data Summary:\\n' || t.summary,
      E'\\nVisualizations Generated:\\n' || array_to_string(list_transform(t.names, lambda x:
        '- ' || x || ': ' || CASE WHEN x = 'technical_indicators' THEN 'indicators' ELSE 'chart' END
        || ' chart showing ' || replace(x, '_', ' ')), E'\\n'),
      E'\\nUser Query: ' || q.query) AS context
  FROM queries q LEFT JOIN grouped g ON q.query_id = g.query_id
  LEFT JOIN texts t ON q.query_id = t.query_id)"""


CENTRES = """means AS (
  SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS mean
  FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
  GROUP BY label, i),
centres AS (SELECT label, list(mean ORDER BY i) AS centre FROM means GROUP BY label)"""

TOKENS = f"""tokens AS (
  SELECT id, unnest(w) AS token, unnest(generate_series(1, len(w))) AS pos
  FROM (SELECT doc_id AS id, {words('lower(text)')} AS w FROM documents)),
vocab AS (
  SELECT token, row_number() OVER (ORDER BY n DESC, token) + 1 AS token_id
  FROM (SELECT token, count(*) AS n FROM tokens GROUP BY token)),
cut AS (
  SELECT t.id, count(*) AS n, string_agg(CAST(v.token_id AS VARCHAR), ' ' ORDER BY pos) AS ids
  FROM tokens t JOIN vocab v ON t.token = v.token WHERE pos <= 512 GROUP BY t.id),
padded AS (
  SELECT d.doc_id AS id, coalesce(c.n, 0) AS n,
    array_to_string(list_concat(CASE WHEN c.n IS NULL THEN [] ELSE string_split(c.ids, ' ') END,
      list_transform(generate_series(1, 512 - coalesce(c.n, 0)), lambda x: '0')), ' ') AS ids
  FROM documents d LEFT JOIN cut c ON d.doc_id = c.id)"""


def _quoted(text: str) -> str:
    return text.replace("'", "''")


def plain(ctes: str, body: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{body}"


ORACLE = {
    "ohlcv_bars_hourly": plain(HOURLY, f"SELECT symbol, ts, {rnds(*OHLCV)} FROM hourly"),
    "ohlcv_bars_auto_width": plain(AUTO_BARS, f"SELECT symbol, ts, {rnds(*OHLCV)} FROM final"),
    "daily_bars_auto_width": plain(AUTO_DAILY, f"SELECT symbol, ts, {rnds(*OHLCV)} FROM final"),
    **{
        f"series_resample_{how}": plain(
            resample(how, points), f"SELECT symbol, ts, {rnds('price', 'settled')} FROM final"
        )
        for how, points in (("mean", 1000), ("sum", 100), ("max", 100), ("min", 1000))
    },
    "series_gap_fill": plain(HOURLY_GRID, f"SELECT symbol, ts, {rnds(*OHLCV)} FROM grid"),
    "series_stats": plain(
        resample("mean", 1000),
        "SELECT symbol, metric, {} FROM (SELECT symbol, 'price' AS metric, price AS v FROM final "
        "UNION ALL SELECT symbol, 'settled', settled FROM final) GROUP BY symbol, metric".format(
            f"CASE WHEN metric = 'price' THEN CAST(({exact_mean('v', 6)} + 5000) // 10000 AS DOUBLE) / 1e6 "
            "ELSE round(avg(v), 6) END AS mean, "
            + ", ".join(
                rnd(f"{f}(v)", n) for f, n in (("stddev_samp", "std"), ("min", "min"), ("max", "max"))
            )
        ),
    ),
    "moving_averages": plain(TICKS, f"SELECT symbol, ts, row_id, {rnd('close')}, {AVERAGES} FROM ticks"),
    "rsi_14": plain(
        f"{TICKS}, {rsi_ctes('ticks')}",
        f"SELECT symbol, ts, row_id, {rnds('close', 'rsi')} FROM relative",
    ),
    "bollinger_20": plain(TICKS, f"SELECT symbol, ts, row_id, {rnd('close')}, {BANDS} FROM ticks"),
    "price_changes": plain(
        f"{TICKS}, {rsi_ctes('ticks')}",
        f"SELECT symbol, ts, row_id, {rnds('close', 'change')} FROM changes",
    ),
    "macd": plain(
        f"{TICKS}, {macd_ctes('ticks')}",
        f"SELECT symbol, ts, row_id, {rnd('close')}, {MACD_COLUMNS} FROM converging",
        recursive=True,
    ),
    "returns": plain(
        f"{TICKS}, {returns_ctes('ticks')}",
        f"SELECT symbol, ts, row_id, {rnds('close', 'simple_return', 'log_return')} FROM earned",
    ),
    "bar_indicators": plain(
        f"{HOURLY_GRID}, bars AS (SELECT *, 0 AS row_id FROM grid), "
        f"{rsi_ctes('bars')}, {macd_ctes('relative')}",
        f"SELECT symbol, ts, {rnd('close')}, {AVERAGES}, {rnd('rsi')}, {BANDS}, {rnds(*MACD_NAMES)} FROM converging",
        recursive=True,
    ),
    "auto_bar_indicators": plain(
        f"{AUTO_BARS}, {rsi_ctes('final')}, {macd_ctes('relative')}",
        f"SELECT symbol, ts, {rnd('close')}, {AVERAGES}, {rnd('rsi')}, {BANDS}, {rnds(*MACD_NAMES)} FROM converging",
        recursive=True,
    ),
    "timeseries_long": plain(
        resample("mean", 1000),
        f"SELECT symbol, ts, row_id, 'price' AS metric, {rnd('price', 'value')} FROM final "
        f"UNION ALL SELECT symbol, ts, row_id, 'settled', {rnd('settled', 'value')} FROM final",
    ),
    "ohlcv_stats": plain(f"{AUTO_BARS}, {returns_ctes('final')}", STATS),
    "tick_stats": plain(
        f"{TICKS}, points AS (SELECT *, close AS high, close AS low FROM ticks), {returns_ctes('points')}",
        STATS,
    ),
    "price_range": plain(
        AUTO_DAILY,
        "SELECT symbol, min(ts) AS first_date, max(ts) AS last_date, "
        f"{rnd('min(close)', 'low_close')}, {rnd('max(close)', 'high_close')} FROM final GROUP BY symbol",
    ),
    "line_points": plain(
        TICKS,
        f"SELECT symbol, 'close' AS name, row_number() OVER ({W}) - 1 AS x, {rnd('close', 'y')} FROM ticks",
    ),
    "candles": plain(AUTO_BARS, f"SELECT symbol, ts, {rnds('open', 'high', 'low', 'close')} FROM final"),
    "series_arrays": plain(
        AUTO_BARS,
        f"SELECT symbol, CAST(row_number() OVER ({W}) - 1 AS INTEGER) AS place, ts AS dates, "
        f"{rnds('close', 'volume')} FROM final",
    ),
    "time_parse": "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS moment FROM events",
    "financial_reports": plain(
        REPORTS,
        "SELECT cik, company_name, filing_type, filing_date, fiscal_year, fiscal_period, "
        f"{rnds(*METRICS, *RATIOS)} FROM reports",
    ),
    "report_validation": plain(
        METRICS_CTE,
        "SELECT cik, fiscal_year, violations = '' AS valid, violations FROM (SELECT *, concat_ws(',', {}) AS violations FROM yearly_facts)".format(
            ", ".join(f"CASE WHEN abs({m}) > {METRIC_LIMIT} THEN '{m}' END" for m in METRICS)
        ),
    ),
    "report_text": plain(REPORTS, f"SELECT cik, fiscal_year, {REPORT_TEXT} AS text_content FROM reports"),
    "latest_fact": plain(
        METRICS_CTE,
        "SELECT cik, {} FROM yearly_facts GROUP BY cik".format(
            ", ".join(
                rnd(f"arg_max({m}, fiscal_year) FILTER ({m} IS NOT NULL)", m) for m in METRICS
            )
        ),
    ),
    "latest_fact_rows": plain(
        METRICS_CTE,
        " UNION ALL ".join(
            f"SELECT cik, '{m}' AS concept, {rnd(f'arg_max({m}, fiscal_year)', 'value')} "
            f"FROM yearly_facts WHERE {m} IS NOT NULL GROUP BY cik"
            for m in METRICS
        ),
    ),
    "training_examples": plain(
        REPORTS,
        f"SELECT {REPORT_TEXT} AS input, 'financial_report' AS type, {rnds(*METRICS, *RATIOS)} FROM reports",
    ),
    "export_round_trip": plain(
        REPORTS,
        f"SELECT {REPORT_TEXT} AS input, 'financial_report' AS type, {rnds(*METRICS, *RATIOS)} FROM reports",
    ),
    "landed_reports": plain(
        f"""{METRICS_CTE}, latest AS (
  SELECT cik, custkey, {', '.join(f'arg_max({m}, fiscal_year) FILTER ({m} IS NOT NULL) AS {m}' for m in METRICS)}
  FROM yearly_facts GROUP BY cik, custkey)""",
        f"""SELECT cik, CASE WHEN coalesce(c_acctbal < 0, true) THEN 'Company ' || cik
    WHEN c_mktsegment = 'MACHINERY' THEN 'Unknown' ELSE c_name END AS company_name,
  '10-K' AS filing_type, CAST(year(TIMESTAMP '{AS_OF}') AS INTEGER) AS fiscal_year, 'FY' AS fiscal_period,
  {rnds(*METRICS)}, {rnd('total_assets / nullif(total_liabilities, 0)', 'current_ratio')},
  {rnd('net_income / nullif(revenue, 0)', 'profit_margin')}, true AS has_id
  FROM latest LEFT JOIN customer ON custkey = c_custkey""",
    ),
    "company_directory": DIRECTORY,
    "first_companies": f"{DIRECTORY} ORDER BY file, pos LIMIT 500",
    "identifiers": """SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
      ltrim(lpad(CAST(o_custkey AS VARCHAR), 10, '0'), '0') AS short_cik,
      CASE WHEN o_orderkey % 5 <> 0 THEN lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '24' || CAST(o_orderkey AS VARCHAR)
        ELSE '' END AS accession FROM orders""",
    "finite_values": plain(
        TICKS,
        "SELECT row_id, CASE WHEN NOT (volume < 10 OR volume > 90 OR volume = 50) THEN close END AS value FROM ticks",
    ),
    "impute_scale": plain(
        f"""{METRICS_CTE}, ratios AS (
  SELECT cik, fiscal_year, total_assets / nullif(total_liabilities, 0) AS current_ratio,
    net_income / nullif(revenue, 0) AS profit_margin FROM yearly_facts),
complete AS (
  SELECT cik, fiscal_year, coalesce(current_ratio, avg(current_ratio) OVER ()) AS current_ratio,
    coalesce(profit_margin, avg(profit_margin) OVER ()) AS profit_margin FROM ratios)""",
        "SELECT cik, fiscal_year, {} FROM complete".format(
            ", ".join(rnd(f"({r} - avg({r}) OVER ()) / stddev_pop({r}) OVER ()", r) for r in RATIOS)
        ),
    ),
    "metric_alignment": plain(
        METRICS_CTE,
        f"SELECT custkey AS company, CAST(fiscal_year AS VARCHAR) AS date, {rnd('revenue')}, "
        f"{rnd('CASE WHEN fiscal_year % 2 = 0 THEN net_income / nullif(revenue, 0) END', 'margin')}, "
        f"{rnd('CASE WHEN fiscal_year % 3 <> 0 THEN net_income END', 'net_income')} FROM yearly",
    ),
    "csv_round_trip": plain(
        REPORTS, f"SELECT cik, company_name, fiscal_year, {rnds(*METRICS, *RATIOS)} FROM reports"
    ),
    "load_counts": plain(
        REPORTS,
        "SELECT step, count(*) AS rows FROM reports, (VALUES ('loaded'), ('exported')) AS s(step) GROUP BY step",
    ),
    "ragged_union": plain(
        METRICS_CTE,
        f"SELECT cik, fiscal_year, {rnd('CASE WHEN has_facts THEN revenue END', 'revenue')}, "
        f"{rnd('CASE WHEN NOT has_facts THEN net_income END', 'net_income')} FROM yearly_facts",
    ),
    "similarity_topk": plain(
        f"""{CENTRES}, pairs AS (
  SELECT label, id, similarity,
    CAST(row_number() OVER (PARTITION BY label ORDER BY round(similarity, 9) DESC, id) AS INTEGER) AS rank
  FROM (SELECT c.label, d.doc_id AS id,
      list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre) AS similarity
    FROM documents d JOIN embeddings e ON d.doc_id = e.vec_id, centres c)
  WHERE similarity > {LABEL_THRESHOLD})""",
        f"SELECT CAST(label AS BIGINT) AS label, id, {rnd('similarity')}, rank FROM pairs WHERE rank <= 5",
    ),
    "ivf_search": plain(
        f"""{CENTRES}, pairs AS (
  SELECT label, id, similarity,
    CAST(row_number() OVER (PARTITION BY label ORDER BY round(similarity, 9) DESC, id) AS INTEGER) AS rank
  FROM (SELECT c.label, e.vec_id AS id,
      list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.centre) AS similarity
    FROM embeddings e, centres c)
  WHERE similarity > {LABEL_THRESHOLD})""",
        f"SELECT CAST(label AS BIGINT) AS label, id, {rnd('similarity')}, rank FROM pairs WHERE rank <= 5",
    ),
    "vector_cosine": plain(
        CENTRES,
        "SELECT vec_id, e.label, "
        f"{rnd('list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre)', 'similarity')} "
        "FROM embeddings e JOIN centres c ON e.label = c.label",
    ),
    "hash_embedding": plain(
        buckets("documents", "doc_id", "text", "dv"),
        f"SELECT id AS doc_id, CAST(bucket AS INTEGER) AS bucket, {rnd('weight')} FROM dv",
    ),
    "query_normalise": plain(
        SPOKEN, f"SELECT conv_id, turn, prepared, {EXPANDED} AS expanded FROM ready"
    ),
    "query_type": plain(SPOKEN, f"SELECT conv_id, turn, {QUERY_TYPE} AS query_type FROM spoken"),
    "expansion_union": plain(
        HITS, f"SELECT query_id, id, {rnd('similarity')}, CAST(place AS INTEGER) AS place, by_expansion FROM hits"
    ),
    "search_depths": plain(
        hits(k="(CASE WHEN query_id % 7 = 0 THEN 5 ELSE query_id % 7 END)"),
        f"SELECT query_id, id, {rnd('similarity')}, CAST(place AS INTEGER) AS place, by_expansion FROM hits",
    ),
    "search_dedupe": plain(
        HITS,
        f"SELECT query_id, id, {rnd('similarity')}, CAST(place AS INTEGER) AS place, by_expansion FROM hits "
        "QUALIFY row_number() OVER (PARTITION BY query_id, id ORDER BY place) = 1",
    ),
    "search_prefiltered": plain(
        hits(DOCS.replace("FROM documents)", "FROM documents WHERE lang = 'en')")),
        f"SELECT query_id, id, {rnd('similarity')}, CAST(place AS INTEGER) AS place FROM hits",
    ),
    "retrieve_filtered": plain(
        FILTERED, f"SELECT query_id, id, {rnd('similarity')}, CAST(place AS INTEGER) AS place FROM chosen"
    ),
    "rerank": plain(
        f"{FOUND}, {scored('found')}",
        f"SELECT query_id, id, CAST(place AS INTEGER) AS place, {rnds('relevance', 'recency', 'score')}, position FROM ranked",
    ),
    "snippets_sources": plain(
        f"{FILTERED}, {scored('chosen')}",
        """SELECT query_id, id, position,
  CASE WHEN length(content) > 200 THEN substr(content, 1, 200) || '...' END AS snippet,
  title, coalesce(CAST(day AS VARCHAR), 'Unknown date') AS date, source,
  format('{:.2f}', similarity * 100) || '%' AS relevance FROM ranked""",
    ),
    "freshness": plain(
        FOUND,
        f"SELECT query_id, CAST(newest AS VARCHAR) AS newest, {FRESHNESS} AS freshness "
        "FROM (SELECT query_id, max(day) AS newest FROM found GROUP BY query_id)",
    ),
    "series_classify": plain(
        USER_DAYS,
        "SELECT user_id, bool_and(full_bar) AS is_ohlcv, count(*) AS records FROM user_days GROUP BY user_id",
    ),
    "chart_choice": plain(
        f"""{USER_DAYS}, choice AS (
  SELECT user_id, bool_and(full_bar) AS is_ohlcv FROM user_days GROUP BY user_id),
titles AS (SELECT * FROM (VALUES
  (true, 0, 'price_chart', 'Price History'), (true, 1, 'technical_indicators', 'Technical Indicators'),
  (false, 0, 'open_chart', 'Open Trend'), (false, 1, 'high_chart', 'High Trend'),
  (false, 2, 'low_chart', 'Low Trend'), (false, 3, 'close_chart', 'Close Trend')) AS v(kind, place, name, title))""",
        "SELECT user_id, CAST(place AS INTEGER) AS place, name, title FROM choice JOIN titles ON is_ohlcv = kind",
    ),
    "metric_projection": plain(METRICS_CTE, f"SELECT {rnds(*METRICS)} FROM yearly_facts"),
    "token_sequences": plain(
        TOKENS,
        "SELECT id, CAST(512 AS INTEGER) AS length, CAST(n AS INTEGER) AS tokens, ids AS input_ids, ids AS labels FROM padded",
    ),
    "token_batches": """SELECT epoch, CAST(floor(place / 8) AS BIGINT) AS batch, place % 8 AS slot, id FROM (
  SELECT epoch, doc_id AS id, row_number() OVER (PARTITION BY epoch ORDER BY
      md5(CAST(doc_id AS VARCHAR) || '|' || CAST(epoch AS VARCHAR) || '|42'), doc_id) - 1 AS place
  FROM documents, (VALUES (0), (1), (2)) AS e(epoch))""",
    "document_store_round_trip": plain(
        f"{DOCS}, {buckets('docs', 'id', 'content', 'dv')}",
        """SELECT d.id, md5(content) AS content_md5, title, CAST(384 AS INTEGER) AS size,
  CAST(coalesce(n, 0) AS INTEGER) AS used, round(coalesce(places, 0.0), 4) AS checksum
FROM docs d LEFT JOIN (
  SELECT id, count(*) AS n, sum(CAST(CAST(weight AS FLOAT) AS DOUBLE) * (bucket + 1)) AS places
  FROM dv GROUP BY id) v ON d.id = v.id""",
    ),
    "document_store_new_ids": plain(
        DOCS,
        "SELECT md5(content) AS content_md5, 2 * count(*) AS rows, 2 * count(*) AS ids FROM docs GROUP BY 1",
    ),
}

ORACLE |= {
    name: plain(
        context(classes),
        f"""SELECT query_id, context, md5('{_quoted(PROMPT_HEAD)}' || context || '{_quoted(PROMPT_TAIL)}') AS prompt_md5,
  array_to_string(list_sort(names), ',') AS visualizations, coalesce(sources, '') AS sources,
  '{AS_OF}' AS timestamp, {QUERY_TYPE} AS query_type, {FRESHNESS} AS data_freshness FROM joined""",
    )
    for name, classes in (("answer_context", DAILY_CLASSES), ("answer_long_series", HOURLY_CLASSES))
}
