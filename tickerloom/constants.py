"""They must equal the published behaviour for results to be right."""

from __future__ import annotations

# ---- labels -----------------------------------------------------------------------------
LABEL_QUANTILE = 0.4
LABEL_WINDOWS = (5, 10)
TEST_LENGTH = 80
VAL_LENGTH = 40
LABELS = {
    "median_gain": {"title": "Median Gain", "positive": "High Gain", "negative": "Low Gain", "threshold_q": 0.9},
    "median_loss": {"title": "Median Loss", "positive": "High Loss", "negative": "Low Loss", "threshold_q": 0.1},
}

# ---- data quality -----------------------------------------------------------------------
MIN_CLOSE_VARIANCE = 1e-10
RECENT_ROWS = 60

# ---- universe ---------------------------------------------------------------------------
LIQUIDITY_QUANTILE = 0.75
UNIVERSE_SIZE = 150
MIN_VALUE_TRADED = 5e9
LIQUIDITY_PENALTY = -10000.0
FUNDAMENTALS = (
    "trailingPE", "forwardPE", "pegRatio", "priceToBook", "returnOnEquity", "returnOnAssets",
    "profitMargins", "operatingMargins", "debtToEquity", "currentRatio", "quickRatio",
    "freeCashflow", "operatingCashflow", "revenueGrowth", "earningsGrowth", "averageVolume",
    "volume", "marketCap", "regularMarketPrice",
)

# ---- flow snapshots ---------------------------------------------------------------------
LOCAL_MONTHS = (("Mei", "May"), ("Agt", "Aug"), ("Okt", "Oct"), ("Des", "Dec"))
SNAPSHOT_COLUMNS = (
    "Stock Code", "Last Trading Date", "Foreign Sell", "Foreign Buy",
    "Non Regular Volume", "Non Regular Value", "Non Regular Frequency",
)
CORPORATE_ACTION_COLUMNS = ("Dividends", "Stock Splits", "Capital Gains")

# ---- features ---------------------------------------------------------------------------
FLOW_WINDOWS = (15, 60, 90)
FEATURES = (
    "ATR Bearish", "ATR Bullish",
    "Accumulation Distribution Line Decreasing", "Accumulation Distribution Line Increasing",
    "Aroon Change Position", "Aroon Down Trend", "Aroon Up Trend",
    "Bear Power 80% Negatives", "Bear Power Trend",
    "Bollinger Overbought", "Bollinger Oversold", "Bollinger Percent B",
    "Bull Power 80% Positives", "Bull Power Up Trend",
    "Crossover CMF",
    "Domestic 15 Days Average Price Over Current Price",
    "Domestic 60 Days Average Price Over Current Price",
    "Domestic 90 Days Average Price Over Current Price",
    "Donchian Overbought", "Donchian Oversold", "Donchian Percent B",
    "Fisher Down Trend", "Fisher Reversal", "Fisher Up trend",
    "Foreign 15 Days Average Price Over Current Price",
    "Foreign 60 Days Average Price Over Current Price",
    "Foreign 90 Days Average Price Over Current Price",
    "Foreign to Domestic 15 Days Ownership",
    "Foreign to Domestic 60 Days Ownership",
    "Foreign to Domestic 90 Days Ownership",
    "Keltner Overbought", "Keltner Oversold", "Keltner Percent B",
    "MACD Near 0", "MACD Non-Near 0 Negative", "MACD Non-Near 0 Positive",
    "MFI Decreasing", "MFI Increasing", "MFI Overbought", "MFI Oversold", "MFI Value",
    "Negative CMF", "OBV to MA20 Ratio",
    "On Balance Volume Decreasing", "On Balance Volume Increasing",
    "Positive CMF",
    "Price Momentum 10D", "Price Momentum 20D", "Price Momentum 5D",
    "RSI 21", "RSI 7", "RSI Down Trend", "RSI Rate of Change 10", "RSI Rate of Change 5",
    "RSI Up Trend", "RSI Value",
    "Stochastic K Value", "Stochastic Oscillator Overbought", "Stochastic Oscillator Oversold",
    "Strong Minus Directional Index", "Strong Negative CMF", "Strong Plus Directional Index",
    "Strong Positive CMF",
    "Volume Ratio 20D",
    "Weak Minus Directional Index", "Weak Plus Directional Index",
    "Width Bollinger Decreasing", "Width Bollinger Increasing",
    "Width Donchian Decreasing", "Width Donchian Increasing",
    "Width Keltner Decreasing", "Width Keltner Increasing",
    "Zig Zag Decreasing", "Zig Zag High", "Zig Zag Increasing", "Zig Zag Low",
)

# ---- models -----------------------------------------------------------------------------
MARKET = "IHSG"
SEED = 17
SEARCH_ITERATIONS = 30
RESTARTS = 10
TREE_ROUNDS = 1000
MODEL_NAMES = {
    "model_v1": "Specific Ticker Model",
    "model_v2": "Specific Industry Model",
    "model_v3": "IHSG Model",
    "model_v4": "Ensemble of Specific Ticker, Specific Industry, and IHSG Model",
}

# ---- scores and recommendations ---------------------------------------------------------
SCORE_EDGES = (0.2, 0.4, 0.6, 0.8, 1.0)
BUY_QUANTILE = 0.25
SELL_QUANTILE = 0.5
SWEEP_STEP = 0.00075
SWEEP_COUNT = 1334

# ---- outlook ----------------------------------------------------------------------------
LOOKBACK_DAYS = 252
SMA_ROWS = 20
VIX_TIERS = (  # (upper bound, exclusive; tier; sentiment; description)
    (15.0, "Low Volatility", "Bullish", "Market is calm and complacent — low fear among investors."),
    (20.0, "Normal", "Neutral", "Typical volatility — no unusual stress detected."),
    (25.0, "Elevated", "Cautious", "Volatility is rising — investors are becoming cautious."),
    (30.0, "High", "Bearish", "Significant fear in the market — risk-off behaviour likely."),
    (None, "Extreme", "Very Bearish", "Panic-level volatility — markets in crisis mode."),
)
FX_TIERS = (  # (upper bound, inclusive; tier; sentiment; description with the change)
    (-0.3, "Strong IDR", "Bullish",
     "Rupiah strengthened significantly (%+.2f%% vs prev close) — positive signal for IDX equity inflows."),
    (-0.05, "Mild IDR Strengthening", "Slightly Bullish",
     "Rupiah modestly stronger (%+.2f%% vs prev close) — slightly supportive for IDX."),
    (0.05, "Stable", "Neutral",
     "USD/IDR is flat (%+.2f%% vs prev close) — no directional pressure from FX."),
    (0.3, "Mild IDR Weakening", "Slightly Bearish",
     "Rupiah mildly weaker (%+.2f%% vs prev close) — minor headwind for IDX."),
    (None, "Sharp IDR Weakening", "Bearish",
     "Rupiah weakened sharply (%+.2f%% vs prev close) — risk-off signal, potential foreign outflows from IDX."),
)
INDEX_TIERS = (  # (upper bound, inclusive; tier; sentiment; description with the name and the change)
    (-2.0, "Sharp Decline", "Very Bearish",
     "%s dropped sharply (%+.2f%%) — strong risk-off signal for emerging markets."),
    (-0.5, "Decline", "Bearish",
     "%s declined (%+.2f%%) — negative sentiment may spill over to IDX."),
    (-0.1, "Mild Decline", "Slightly Bearish",
     "%s edged lower (%+.2f%%) — mild caution, limited directional impact."),
    (0.1, "Flat", "Neutral",
     "%s was flat (%+.2f%%) — no clear directional cue."),
    (0.5, "Gain", "Slightly Bullish",
     "%s gained modestly (%+.2f%%) — mildly supportive for regional sentiment."),
    (None, "Strong Rally", "Bullish",
     "%s rallied (%+.2f%%) — positive risk appetite, likely tailwind for IDX."),
)
SENTIMENT_SCORES = {
    "Very Bearish": -2.0, "Bearish": -1.0, "Slightly Bearish": -0.5, "Cautious": -0.5,
    "Neutral": 0.0, "Slightly Bullish": 0.5, "Bullish": 1.0,
}
OUTLOOK_TIERS = (  # (lower bound, inclusive; outlook)
    (0.5, "Bullish"), (0.0, "Neutral-to-Bullish"), (-0.5, "Neutral-to-Bearish"), (None, "Bearish"),
)
