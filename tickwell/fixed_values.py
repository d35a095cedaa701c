"""Values that have to stay exactly as they are for results to agree."""

# ---- Fixed values: filing facts ------------------------------------------
CONCEPTS = {
    "revenue": "Revenues",
    "net_income": "NetIncomeLoss",
    "total_assets": "Assets",
    "total_liabilities": "Liabilities",
    "operating_cash_flow": "NetCashProvidedByUsedInOperatingActivities",
}
TAXONOMY = "us-gaap"
FILING_TYPE = "10-K"
FISCAL_PERIOD = "FY"
UNKNOWN_COMPANY = "Unknown"
MADE_COMPANY_NAME = "Company {cik}"
COMPANY_LIMIT = 500
METRIC_BOUND = 1e12

# ---- Fixed values: report text -------------------------------------------
# Names in braces stand for columns; every line is indented by eight blanks.
REPORT_TEXT = """
        Financial Report for {company_name} (CIK: {cik})
        Filing Date: {filing_date}
        Fiscal Year: {fiscal_year}
        
        Key Financial Metrics:
        - Revenue: ${revenue}
        - Net Income: ${net_income}
        - Total Assets: ${total_assets}
        - Total Liabilities: ${total_liabilities}
        - Operating Cash Flow: ${operating_cash_flow}
        """
NO_VALUE = "nan"
TRAINING_TYPE = "financial_report"

# ---- Fixed values: retrieval ---------------------------------------------
TOP_K = 5
SIMILARITY_THRESHOLD = 0.7
VECTOR_SIZE = 384
INDEX_LISTS = 100
CONTEXT_TRIGGERS = ["stock", "price", "market"]
CONTEXT_SUFFIX = " financial market analysis"
EXPANSIONS = {"stock": "equity shares", "price": "value cost"}
RELEVANCE_WEIGHT = 0.7
RECENCY_WEIGHT = 0.3
TITLE_TERM_BONUS = 0.1
DAILY_DECAY = 0.99
NO_DATE_RECENCY = 0.5
SNIPPET_LENGTH = 200

# ---- Fixed values: answers -----------------------------------------------
QUERY_TYPES = [
    ("price_analysis", ["price", "stock", "ohlc", "candlestick"]),
    ("trend_analysis", ["trend", "compare", "correlation"]),
    ("prediction", ["forecast", "predict", "future"]),
]
OTHER_QUERY_TYPE = "general_analysis"
FRESHNESS_DAYS = [("very_fresh", 1), ("fresh", 7), ("recent", 30)]
OLD_DATA = "historical"
NO_DATES = "unknown"
SOURCE_DEFAULTS = {
    "title": "Untitled",
    "date": "Unknown date",
    "source": "Unknown source",
}
OHLCV_CHARTS = {
    "price_chart": "Price History",
    "technical_indicators": "Technical Indicators",
}
LINE_CHART = "{metric}_chart"
LINE_CHART_TITLE = "{metric} Trend"
CHART_DESCRIPTION = "- {name}: {kind} chart showing {words}"
PRICE_SUMMARY = "Price data available from {first} to {last}. Price range: ${low} - ${high}"
SERIES_SUMMARY = "Time series data for {metrics} from {first} to {last}"
RETRIEVED_HEADING = "Retrieved Information:"
SERIES_HEADING = "\nFinancial Data Summary:"
CHARTS_HEADING = "\nVisualizations Generated:"
QUERY_HEADING = "\nUser Query: "
PROMPT_HEAD = (
    "Based on the following context, provide a detailed financial analysis. \n"
    "Include specific insights from the data and references to any visualizations.\n\n"
)
PROMPT_TAIL = (
    "\n\nProvide a comprehensive analysis with:\n"
    "1. Direct answer to the query\n"
    "2. Key insights from the data\n"
    "3. Relevant trends or patterns\n"
    "4. References to specific visualizations\n"
    "5. Any important caveats or limitations\n\n"
    "Analysis:"
)

# ---- Fixed values: series ------------------------------------------------
MAX_POINTS = 1000
MOVING_AVERAGES = [5, 10, 20, 50]
RSI_ROWS = 14
BOLLINGER_ROWS = 20
BOLLINGER_WIDTH = 2
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
TRADING_DAYS = 252

# ---- Fixed values: training batches --------------------------------------
SEQUENCE_LENGTH = 512
BATCH_SIZE = 8
