"""SQL counterpart of every registered query that SQL can express."""

from __future__ import annotations

from oracle import indicators, models
from oracle.ctes import BIN, METRICS, PARTS, SPLIT, TRAIN_OR_TEST, rounded, score, statement

ORACLE: dict[str, str] = {**indicators.SQL, **models.SQL}
OHLC = "open high low close"
W = "PARTITION BY ticker ORDER BY date"


def add(name: str, body: str, doubles: str = "", digits: int = 6, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = statement(rounded(body, doubles, digits) if doubles else body, extra)


# ---- sources -----------------------------------------------------------------------------
add("scan_ticker_files", "SELECT * REPLACE (CAST(ticker AS VARCHAR) AS ticker) FROM bars", OHLC)
add("scan_pruned", "SELECT ticker, date, close FROM bars", "close")
add("scan_tickers_of_industry", """SELECT * FROM bars WHERE ticker IN
 (SELECT ticker FROM industry WHERE industry = 'NATION_15')""", OHLC)
add("normalize_ohlcv", """SELECT ticker AS "Ticker", date AS "Date", open AS "Open", high AS "High", low AS "Low",
 close AS "Close", volume AS "Volume" FROM bars""", "Open High Low Close")
add("clean_flow_snapshot", """SELECT ticker AS "Stock Code",
 CAST(strptime(replace(replace(replace(replace(text, 'Mei', 'May'), 'Agt', 'Aug'), 'Okt', 'Oct'), 'Des', 'Dec'),
 '%d %b %Y') AS DATE) AS "Last Trading Date", foreign_sell AS "Foreign Sell", foreign_buy AS "Foreign Buy",
 non_regular_volume AS "Non Regular Volume", non_regular_value AS "Non Regular Value",
 non_regular_frequency AS "Non Regular Frequency" FROM snapshots""", ["Non Regular Value"], 4)
add("split_flow_per_ticker", """SELECT * EXCLUDE (landing, n) FROM (SELECT *, row_number() OVER
 (PARTITION BY ticker, date ORDER BY landing) AS n FROM landings) WHERE n = 1""", "non_regular_value", 4)
add("active_market_dates", "SELECT DISTINCT date FROM bars")
add("backfill_dates", """SELECT DISTINCT date FROM bars WHERE date NOT IN (SELECT CAST(o_orderdate AS DATE)
 FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')""")
add("write_overwrite_partitioned", "SELECT ticker, count(*) AS bars, sum(volume) AS volume FROM bars GROUP BY ticker")
add("refresh_tickers", """SELECT ticker, count(*) AS bars,
 CASE WHEN ticker % 3 = 0 THEN sum(volume) ELSE CAST(-count(*) AS DOUBLE) END AS volume FROM bars GROUP BY ticker""")
add("split_dates_sink", "SELECT * FROM splits_5")
_FORECASTS = [(v, label, name, w) for v in (1, 2, 3)
              for label, name in (("median_gain", "High Gain"), ("median_loss", "High Loss")) for w in (5, 10)]
_WIDE = ", ".join(
    f"max(p) FILTER (model_version = {v} AND label_type = '{label}' AND \"window\" = {w}) AS "
    f"\"Forecast {name} {w}dd - V{v}\"" for v, label, name, w in _FORECASTS)
_ALL = " AND ".join(f"\"Forecast {name} {w}dd - V{v}\" IS NOT NULL" for v, _, name, w in _FORECASTS)
_COMBINED = {"wide": f"""SELECT f.*, "Threshold Median Gain 10dd", "Median Gain 10dd" FROM
 (SELECT ticker, date, {_WIDE} FROM forecasts GROUP BY ticker, date) f JOIN labelled USING (ticker, date)
 WHERE {_ALL}"""}
_NAMES = [("feature", f"Forecast {name} {w}dd - V{v}") for v, _, name, w in _FORECASTS]
_NAMES += [("target", "Median Gain 10dd"), ("threshold", "Threshold Median Gain 10dd")]
add("column_info_config", " UNION ALL ".join(
    f"SELECT {i} AS position, '{role}' AS role, '{c}' AS column_name, count(\"{c}\") AS filled FROM wide"
    for i, (role, c) in enumerate(_NAMES)), extra=_COMBINED)
add("ticker_list_scan", "SELECT s_name AS ticker FROM supplier")
_SIDES = [f"{side}_{m}" for side in ("train", "test") for m in METRICS]
add("performance_scan", f"""SELECT ticker, {', '.join(_SIDES)}, threshold,
 CASE model_version WHEN 1 THEN 'Specific Ticker Model' WHEN 2 THEN 'Specific Industry Model' WHEN 3 THEN 'IHSG Model'
  ELSE 'Ensemble of Specific Ticker, Specific Industry, and IHSG Model' END AS model_version,
 "window" || 'dd' AS "window", CASE label_type WHEN 'median_gain' THEN 'Median Gain' ELSE 'Median Loss' END AS label_type,
 CASE model_version WHEN 1 THEN 'Specific Ticker Model' WHEN 2 THEN 'Specific Industry Model' WHEN 3 THEN 'IHSG Model'
  ELSE 'Ensemble of Specific Ticker, Specific Industry, and IHSG Model' END || ' - ' || CASE label_type WHEN 'median_gain' THEN 'Median Gain' ELSE 'Median Loss' END
  || ' - ' || "window" || 'dd' AS model_identifier FROM performance""", _SIDES + ["threshold"])

# ---- scalar ------------------------------------------------------------------------------
add("num_coerce", """SELECT event_id, coalesce(CASE WHEN event_type <> 'error'
 THEN TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) END, -1e0) AS value FROM events""")
add("clip", """SELECT c_custkey, CASE WHEN c_acctbal IS NOT NULL THEN greatest(0e0, least(5000e0, c_acctbal)) END AS "both",
 CASE WHEN c_acctbal IS NOT NULL THEN greatest(1000e0, c_acctbal) END AS lower_only,
 CASE WHEN c_acctbal IS NOT NULL THEN least(2000e0, c_acctbal) END AS upper_only FROM customer""")
_PLACE = "CASE WHEN high <> low THEN (close - low) / (high - low) END"
add("safe_divide", f"SELECT ticker, date, {_PLACE} AS place FROM bars", "place")
add("inf_to_null", """SELECT c_custkey, c_acctbal / 4 > 709.782712893384 AS overflow,
 CASE WHEN c_acctbal / 4 <= 709.782712893384 THEN log10(exp(c_acctbal / 4)) END AS digits FROM customer""", "digits")
add("parse_local_date", "SELECT ticker, text, date, landing FROM snapshots")
add("iso_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders")
add("drop_null_rows", """SELECT ticker, date, close, foreign_buy, foreign_sell, 'all' AS kept_by
 FROM bars JOIN flow USING (ticker, date) UNION ALL
 SELECT ticker, date, close, foreign_buy, foreign_sell, 'subset' FROM bars LEFT JOIN flow USING (ticker, date)""", "close")
_GATE = """SELECT c.ticker, coalesce(bars, 0) AS bars, variance, reason IS NULL AS passed, reason FROM (
 SELECT c_custkey AS ticker, m.bars, m.variance, CASE WHEN m.bars IS NULL THEN 'no price bars'
  WHEN f.ticker IS NULL THEN 'no flow data' WHEN variance < 1e-10 THEN 'no price variation' END AS reason
 FROM (SELECT DISTINCT c_custkey FROM customer)
 LEFT JOIN (SELECT ticker, count(*) AS bars, var_pop(close) AS variance FROM bars GROUP BY ticker) m ON m.ticker = c_custkey
 LEFT JOIN (SELECT DISTINCT ticker FROM flow) f ON f.ticker = c_custkey) c"""
add("quality_gate_full", _GATE, "variance", 2)
add("quality_gate_recent", """SELECT *, variance >= 1e-10 AS passed,
 CASE WHEN variance < 1e-10 THEN 'no price variation' END AS reason FROM (
 SELECT ticker, count(*) AS bars, var_pop(close) AS variance FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM bars) WHERE n <= 60
 GROUP BY ticker)""", "variance", 2)
add("split_masks", f"""SELECT ticker, date, {SPLIT} AS split, date BETWEEN train_start AND val_end AS train_val
 FROM bars, splits_5""")
add("isin_filter", """SELECT * FROM forecasts WHERE model_version IN (1, 3) AND label_type = 'median_gain' AND "window" = 5""", "p")
add("feature_presence_check", " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, true AS present, count({c}) AS rows FROM bars" for c in ("open", "close", "volume")]
    + [f"SELECT '{c}', false, 0 FROM (SELECT count(*) FROM bars)" for c in ("foreign_buy", "non_regular_value")]))
add("label_config", " UNION ALL ".join(
    f"""SELECT 'Median {title} {w}dd' AS target, 'Threshold Median {title} {w}dd' AS threshold, 'High {title}' AS positive,
 'Low {title}' AS negative, count(*) FILTER ("Median {title} {w}dd" = 'High {title}') AS positives,
 count(*) FILTER ("Median {title} {w}dd" = 'Low {title}') AS negatives FROM labelled"""
    for title in ("Gain", "Loss") for w in (5, 10)))
add("score_bin", f"SELECT ticker, date, score, {BIN} AS bin FROM scores")
add("score_threshold_bucket", """SELECT * FROM (SELECT *, CASE WHEN score >= 0 AND score < 0.2 THEN '0.0 <= x < 0.2'
 WHEN score < 0.4 THEN '0.2 <= x < 0.4' WHEN score < 0.6 THEN '0.4 <= x < 0.6' WHEN score < 0.8 THEN '0.6 <= x < 0.8'
 WHEN score < 1 THEN '0.8 <= x < 1' END AS bucket FROM scores) WHERE bucket IS NOT NULL""")
add("target_prices", f"""SELECT ticker, date, CAST(floor(close * (100 - abs({score(31, 17)} * -10)) / 100) AS DOUBLE) AS buy,
 CAST(ceil(close * (100 + abs({score(7, 3)} * 10)) / 100) AS DOUBLE) AS sell FROM bars""")
add("clean_float", f"SELECT ticker, date, coalesce({_PLACE}, 0e0) AS x FROM bars", "x")
add("prefix_metric_columns", "SELECT ticker, threshold, " + ", ".join(
    f"{side.lower()}_{m} AS \"{side} - {m}\"" for side in ("Train", "Test") for m in METRICS) + " FROM gain_performance"
    " WHERE train_gini IS NOT NULL AND test_gini IS NOT NULL",
    [f"{side} - {m}" for side in ("Train", "Test") for m in METRICS] + ["threshold"])
add("camel_label", """SELECT label_type, CASE label_type WHEN 'median_gain' THEN 'medianGain' ELSE 'medianLoss' END AS folder,
 count(*) AS rows FROM forecasts GROUP BY label_type""")
add("lookback_filter", """SELECT ticker, date, close FROM bars
 WHERE date >= (SELECT max(date) FROM bars) - 252""", "close")

_DAILY = {"daily": """SELECT *, 100 * (close - pc) / pc AS raw FROM (
 SELECT *, lag(close) OVER (PARTITION BY index_name ORDER BY date) AS pc FROM index_bars) WHERE pc IS NOT NULL"""}


def chain(value, table, op, fallback):
    return "CASE " + " ".join(f"WHEN {value} {op} {bound} THEN {out}" for bound, out in table) + f" ELSE {fallback} END"


# half away from zero on the decimal digits, as the formatter does
_PCT = "printf('%+.2f', CAST(round(CAST(c AS DECIMAL(18, 4)), 2) AS DOUBLE)) || '%"
_FX = [
    (-0.3, "Strong IDR", "Bullish", "Rupiah strengthened significantly (", " vs prev close) — positive signal for IDX equity inflows."),
    (-0.05, "Mild IDR Strengthening", "Slightly Bullish", "Rupiah modestly stronger (", " vs prev close) — slightly supportive for IDX."),
    (0.05, "Stable", "Neutral", "USD/IDR is flat (", " vs prev close) — no directional pressure from FX."),
    (0.3, "Mild IDR Weakening", "Slightly Bearish", "Rupiah mildly weaker (", " vs prev close) — minor headwind for IDX."),
    (None, "Sharp IDR Weakening", "Bearish", "Rupiah weakened sharply (", " vs prev close) — risk-off signal, potential foreign outflows from IDX."),
]
_INDEX = [
    (-2, "Sharp Decline", "Very Bearish", " dropped sharply (", ") — strong risk-off signal for emerging markets."),
    (-0.5, "Decline", "Bearish", " declined (", ") — negative sentiment may spill over to IDX."),
    (-0.1, "Mild Decline", "Slightly Bearish", " edged lower (", ") — mild caution, limited directional impact."),
    (0.1, "Flat", "Neutral", " was flat (", ") — no clear directional cue."),
    (0.5, "Gain", "Slightly Bullish", " gained modestly (", ") — mildly supportive for regional sentiment."),
    (None, "Strong Rally", "Bullish", " rallied (", ") — positive risk appetite, likely tailwind for IDX."),
]
_VIX = [
    (15, "Low Volatility", "Bullish", "Market is calm and complacent — low fear among investors."),
    (20, "Normal", "Neutral", "Typical volatility — no unusual stress detected."),
    (25, "Elevated", "Cautious", "Volatility is rising — investors are becoming cautious."),
    (30, "High", "Bearish", "Significant fear in the market — risk-off behaviour likely."),
    (None, "Extreme", "Very Bearish", "Panic-level volatility — markets in crisis mode."),
]


def pick(value, table, op, column):
    outs = [(row[0], column(row)) for row in table]
    return chain(value, outs[:-1], op, outs[-1][1])


def fx(part):
    column = {"tier": lambda r: f"'{r[1]}'", "sentiment": lambda r: f"'{r[2]}'",
              "description": lambda r: f"'{r[3]}' || {_PCT}{r[4]}'"}[part]
    return pick("c", _FX, "<=", column)


def index(part, name="index_name"):
    column = {"tier": lambda r: f"'{r[1]}'", "sentiment": lambda r: f"'{r[2]}'",
              "description": lambda r: f"{name} || '{r[3]}' || {_PCT}{r[4]}'"}[part]
    return pick("c", _INDEX, "<=", column)


def vix(part, value):
    return pick(value, _VIX, "<", lambda r: f"'{r[{'tier': 1, 'sentiment': 2, 'description': 3}[part]]}'")


THREE = ("tier", "sentiment", "description")
add("sentiment_template", f"""SELECT index_name, date, {fx('description')} AS fx_text, {index('description')} AS index_text
 FROM (SELECT *, round_even(raw, 4) AS c FROM daily)""", extra=_DAILY)
add("classify_vix", "SELECT index_name, date, " + ", ".join(f"{vix(p, 'close')} AS {p}" for p in THREE) + " FROM index_bars")
add("classify_fx", "SELECT index_name, date, c AS change_pct, " + ", ".join(f"{fx(p)} AS {p}" for p in THREE)
    + " FROM (SELECT *, round_even(raw, 4) AS c FROM daily)", extra=_DAILY)
add("classify_index", "SELECT index_name, date, c AS change_pct, " + ", ".join(f"{index(p)} AS {p}" for p in THREE)
    + " FROM (SELECT *, round_even(raw, 4) AS c FROM daily)", extra=_DAILY)
add("selected_universe", "SELECT DISTINCT c_custkey AS ticker FROM customer WHERE c_custkey IN (SELECT ticker FROM bars)")

# ---- joins -------------------------------------------------------------------------------
add("join_bars_flow", "SELECT * FROM bars JOIN flow USING (ticker, date)", OHLC + " non_regular_value", 4)
add("join_performance", "SELECT ticker, date, score, train_gini, test_gini FROM scores JOIN gain_performance USING (ticker)",
    "score train_gini test_gini")
add("join_industry", """SELECT ticker, industry, fundamental_score, 'table' AS source FROM scored JOIN industry USING (ticker)
 UNION ALL SELECT ticker, 'Unknown', fundamental_score, 'none' FROM scored""", "fundamental_score")
_COMBINED_BODY = "SELECT * FROM wide"
_COMBINED_DOUBLES = [c for role, c in _NAMES if role != "target"]
add("combine_forecasts", _COMBINED_BODY, _COMBINED_DOUBLES, extra=_COMBINED)
add("trading_simulation", "SELECT * FROM simulation", "score close max_close min_close profit loss")


def index_moves(w):
    f = f"OVER (ORDER BY date ROWS BETWEEN 1 FOLLOWING AND {w} FOLLOWING)"
    return (f"SELECT index_name, date, 100 * (CASE WHEN count(close) {f} = {w} THEN quantile_cont(close, 0.4) {f} END "
            f"- close) / close AS median_gain FROM market_index")


_INDEX_SCORE = {
    "averages": "SELECT date, avg(score) AS avg_score FROM scores GROUP BY date",
    **{f"imoves_{w}": index_moves(w) for w in (5, 10)},
    **{f"ijoined_{w}": f"SELECT * FROM imoves_{w} JOIN averages USING (date) WHERE median_gain IS NOT NULL" for w in (5, 10)},
}
add("join_index_score", "SELECT * FROM ijoined_5", "median_gain avg_score", extra=_INDEX_SCORE)
add("ticker_availability", """SELECT ticker FROM (SELECT DISTINCT ticker, model_version, label_type, "window" FROM forecasts)
 GROUP BY ticker HAVING count(*) = 12""")
_STEPS = {"steps": "SELECT range * 0.00075e0 AS threshold FROM range(1334)"}


def sweep(metric, columns):
    return f"""SELECT threshold, {columns} FROM steps LEFT JOIN (SELECT * FROM simulation WHERE {metric} IS NOT NULL)
 ON score >= threshold GROUP BY threshold"""


add("threshold_sweep_join", sweep("loss", "count(loss) AS rows, avg(loss) AS mean"), "threshold mean", extra=_STEPS)
add("threshold_sweep", sweep("profit", """count(profit) AS rows, avg(profit) AS mean, max(profit) AS max, min(profit) AS min,
 quantile_cont(profit, 0.25) AS q25, quantile_cont(profit, 0.5) AS q50, quantile_cont(profit, 0.75) AS q75"""),
    "threshold mean max min q25 q50 q75", extra=_STEPS)
add("attach_bin_targets", f"""SELECT ticker, date, bin, buy_pct, sell_pct
 FROM (SELECT *, {BIN} AS bin FROM scores) LEFT JOIN targets USING (bin)""", "buy_pct sell_pct")
add("route_model", " UNION ALL ".join(
    f"""SELECT ticker, {who} AS model_identifier, '{label}' AS label_type, {w} AS "window", {v} AS model_version FROM industry"""
    for v, who in ((1, "CAST(ticker AS VARCHAR)"), (2, "industry"), (3, "'IHSG'"), (4, "'IHSG'"))
    for label in ("median_gain", "median_loss") for w in (5, 10)))

# ---- aggregations ------------------------------------------------------------------------
add("liquidity_cutoff", "SELECT ticker, avg_value_traded FROM liquid", "avg_value_traded", 2)
add("industry_counts", "SELECT industry, count(*) AS tickers FROM industry GROUP BY industry")
add("label_threshold", """SELECT ticker, gain_5 AS threshold, 'median_gain' AS label_type FROM limits
 UNION ALL SELECT ticker, loss_5, 'median_loss' FROM limits""", "threshold")
add("make_splits", """SELECT *, 5 AS "window" FROM splits_5 UNION ALL SELECT *, 10 FROM splits_10""")
add("avg_score_by_date", "SELECT date, avg(score) AS avg_score FROM scores GROUP BY date", "avg_score")


def described(value, source, keys=""):
    return f"""SELECT {keys}CAST(count({value}) AS DOUBLE) AS "count", avg({value}) AS mean, stddev_samp({value}) AS std,
 min({value}) AS min, quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS q50,
 quantile_cont({value}, 0.75) AS q75, max({value}) AS max FROM {source}"""


EIGHT = "mean std min q25 q50 q75 max"
add("describe", described("l_extendedprice", "lineitem GROUP BY l_returnflag", "l_returnflag, "), EIGHT, 4)
add("bin_buy_sell_pct", "SELECT * FROM targets", "buy_pct sell_pct")
add("score_distribution", """SELECT bucket, count(profit) AS rows, min(profit) AS min, quantile_cont(profit, 0.25) AS q25,
 quantile_cont(profit, 0.5) AS median, quantile_cont(profit, 0.75) AS q75, max(profit) AS max FROM (
 SELECT *, CASE WHEN score < 0.2 THEN '0.0 <= x < 0.2' WHEN score < 0.4 THEN '0.2 <= x < 0.4'
  WHEN score < 0.6 THEN '0.4 <= x < 0.6' WHEN score < 0.8 THEN '0.6 <= x < 0.8' WHEN score < 1 THEN '0.8 <= x < 1' END
  AS bucket FROM simulation) WHERE bucket IS NOT NULL GROUP BY bucket""", "min q25 median q75 max")
add("classification_metrics", "SELECT * EXCLUDE (gini) FROM metrics", [m for m in METRICS if m != "gini"])
add("gini", "SELECT ticker, split, gini FROM metrics", "gini")
add("performance_by_ticker", "SELECT * FROM gain_performance", _SIDES + ["threshold"])
add("select_best_restart", """SELECT model_version AS restart, median_gini FROM (
 SELECT model_version, quantile_cont(test_gini, 0.5) AS median_gini FROM performance GROUP BY model_version)
 ORDER BY median_gini DESC, model_version LIMIT 1""", "median_gini")
_LAST = {"lastindex": """SELECT index_name, max(date) AS date, max(close) FILTER (age = 1) AS close,
 max(close) FILTER (age = 2) AS previous, avg(close) FILTER (age <= 20) AS sma20 FROM (
 SELECT *, row_number() OVER (PARTITION BY index_name ORDER BY date DESC) AS age FROM index_bars) GROUP BY index_name"""}
add("percentile_rank", """SELECT b.index_name, round_even(count(*) FILTER (b.close < l.close) / count(*) * 100, 2)
 AS percentile_rank FROM index_bars b JOIN lastindex l ON l.index_name = b.index_name GROUP BY b.index_name""", extra=_LAST)
add("single_date_assert", " UNION ALL ".join(
    f"""SELECT count(DISTINCT date) AS dates, count(*) AS rows, count(DISTINCT date) <= 1 AS passed, '{name}' AS checked
 FROM (SELECT ticker, max(date) AS date FROM scores{only} GROUP BY ticker)"""
    for name, only in (("newest date", " WHERE date = (SELECT max(date) FROM scores)"), ("latest of each ticker", ""))))
add("tickers_meeting_gini", "SELECT ticker, test_gini FROM gain_performance WHERE test_gini >= 0.1", "test_gini")
add("run_summary", f"""SELECT coalesce(reason, 'succeeded') AS outcome, count(*) AS tickers,
 CAST(sum(bars) AS BIGINT) AS total_rows FROM ({_GATE}) GROUP BY 1""")

# ---- windows -----------------------------------------------------------------------------
add("forward_quantile", "SELECT ticker, date, ahead_5, ahead_10 FROM aheads", "ahead_5 ahead_10")
add("forward_max", "SELECT ticker, date, max_close FROM extremes", "max_close")
add("forward_min", "SELECT ticker, date, min_close FROM extremes", "min_close")
_F10 = f"OVER ({W} ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING)"
add("forward_return", f"""SELECT ticker, date, 100 * (CASE WHEN count(close) {_F10} = 10 THEN max(close) {_F10} END - close)
 / close AS move FROM bars""", "move")


def trailing(agg, n):
    f = f"OVER ({W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(*) {f} = {n} THEN {agg} {f} END"


add("rolling_sum", "SELECT ticker, date, " + ", ".join(
    f"{trailing('sum(volume)', n)} AS sum_{n}" for n in (15, 60, 90)) + " FROM bars")
add("rolling_mean", f"SELECT ticker, date, {trailing('avg(volume)', 20)} AS mean_20 FROM bars", "mean_20")
add("rolling_median_adaptive", f"""SELECT ticker, date, quantile_cont(close, 0.5) OVER ({W} ROWS BETWEEN 49 PRECEDING
 AND CURRENT ROW) AS median_50 FROM bars""", "median_50")
add("pct_change", "SELECT ticker, date, " + ", ".join(
    f"close / lag(close, {n}) OVER ({W}) - 1 AS change_{n}" for n in (5, 10, 20)) + " FROM bars", "change_5 change_10 change_20")
add("lag_diff", "SELECT ticker, date, " + ", ".join(
    f"close - lag(close, {n}) OVER ({W}) AS diff_{n}" for n in (5, 10)) + " FROM bars", "diff_5 diff_10")
add("shift_all", "SELECT ticker, date, " + ", ".join(
    f"lag({c}) OVER ({W}) AS {c}" for c in ("foreign_buy", "foreign_sell", "volume"))
    + " FROM bars JOIN flow USING (ticker, date)")
add("trend_slope", f"""SELECT ticker, date, CASE WHEN rn > 10 THEN CASE WHEN slope > 0 THEN 1e0 ELSE 0e0 END END AS rising,
 CASE WHEN rn > 10 THEN CASE WHEN slope < 0 THEN 1e0 ELSE 0e0 END END AS falling FROM (
 SELECT *, regr_slope(close, rn) OVER ({W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS slope FROM b)""")
add("positives_share", f"""SELECT ticker, date, CASE WHEN rn > 10 THEN CASE WHEN count(*) FILTER (close > open)
 OVER ({W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) >= 4 THEN 1e0 ELSE 0e0 END END AS mostly_up FROM b""")
add("crossover_flag", f"""SELECT ticker, date, CAST((close >= open) <> lag(close >= open) OVER ({W}) AS INTEGER) AS crossed FROM bars""")
add("sign_change_flag", f"""SELECT ticker, date, CAST(m * lag(m) OVER ({W}) <= 0 AS INTEGER) AS changed
 FROM (SELECT *, close - pc AS m FROM b)""")
add("latest_per_ticker", """SELECT ticker, max(date) AS date, arg_max(close, date) AS close, arg_max(volume, date) AS volume
 FROM bars GROUP BY ticker""", "close")
add("latest_and_previous", """SELECT index_name, date, close, previous,
 round_even(100 * (close - previous) / previous, 4) AS change_pct FROM lastindex""", extra=_LAST)
add("tail_mean", "SELECT index_name, sma20, 100 * (close - sma20) / sma20 AS deviation_pct FROM lastindex",
    "sma20 deviation_pct", extra=_LAST)
add("first_threshold", "SELECT ticker, arg_min(threshold, date) AS threshold FROM predictions GROUP BY ticker", "threshold")
add("dedupe_first", "SELECT ticker, date, price, quantity FROM trades WHERE seq = 1", "price")

# ---- labels and scores -------------------------------------------------------------------
for _kind in ("Gain", "Loss"):
    _t = f"Median {_kind} 5dd"
    add(f"label_median_{_kind.lower()}", f'SELECT ticker, date, close, "Threshold {_t}", "{_t}" FROM labelled',
        ["close", f"Threshold {_t}"])
add("bucketed_labels", """SELECT ticker, date, close, "Threshold Median Gain 5dd", "Median Gain 5dd" FROM labelled
 WHERE (ticker, date) IN (SELECT (ticker, date) FROM flow)""", ["close", "Threshold Median Gain 5dd"])
add("label_all", "SELECT * FROM labelled", ["close"] + [f"Threshold Median {k} {w}dd" for k in ("Gain", "Loss") for w in (5, 10)])
add("split_train_test", f"""SELECT * FROM (SELECT ticker, date, close, volume, "Median Gain 5dd" AS y_true,
 CASE WHEN "Median Gain 5dd" = 'High Gain' THEN 1e0 ELSE 0e0 END AS label,
 CASE WHEN date BETWEEN test_start AND test_end THEN 'test' WHEN date BETWEEN val_start AND val_end THEN 'val'
  WHEN date BETWEEN train_start AND val_end THEN 'train' END AS fold
 FROM labelled JOIN bars USING (ticker, date, close), splits_5 WHERE "Median Gain 5dd" IS NOT NULL)
 WHERE fold IS NOT NULL""", "close")
_PREPARED = {"prepared": f"""SELECT ticker, date, {score(32, 22)} AS p, "Median Gain 5dd" AS y_true, {SPLIT} AS split,
 coalesce(CASE WHEN {TRAIN_OR_TEST} = 'train' THEN train_gini ELSE test_gini END, 0e0) AS gini
 FROM labelled JOIN gain_performance USING (ticker), splits_5
 WHERE date BETWEEN train_start AND train_end OR date >= test_start"""}
add("score_prepare", "SELECT * FROM prepared", "p gini", extra=_PREPARED)
add("score_infer", """SELECT ticker, date, split, 1 / (1 + exp(-(-2e0 + p * 3e0 + gini * 0.5e0))) AS score
 FROM prepared WHERE split IN ('test', 'forecast')""", "score", extra=_PREPARED)
_FITTED = {
    **_PREPARED, **models.newton("score_rows"),
    "score_rows": """SELECT p, gini, CASE WHEN y_true = 'High Gain' THEN 1e0 ELSE 0e0 END AS y FROM prepared
 WHERE split = 'train' AND y_true IS NOT NULL""",
}
add("score_train", """SELECT split, rows, b AS intercept, w AS p_weight, g AS gini_weight
 FROM (SELECT split, count(*) AS rows FROM prepared GROUP BY split), fitted""", "intercept p_weight gini_weight", 4, _FITTED)
add("score_fitted", """SELECT ticker, date, split, 1 / (1 + exp(-(b + w * p + g * gini))) AS score
 FROM prepared, fitted WHERE split IN ('test', 'forecast')""", "score", 4, _FITTED)
add("score_test_rows", "SELECT ticker, date, score, test_gini FROM test_scores JOIN gain_performance USING (ticker)",
    "score test_gini")

# ---- universe, outlook, recommendations --------------------------------------------------
for _name, _sql in PARTS.items():
    add(f"score_{_name}", f"SELECT ticker, {_sql} AS score FROM fundamentals", "score")
add("fundamental_score", "SELECT ticker, avg_value_traded, fundamental_score FROM scored", "avg_value_traded fundamental_score", 4)
add("select_universe", """SELECT ticker, industry, avg_value_traded, fundamental_score FROM industry JOIN (
 SELECT * FROM liquid ORDER BY fundamental_score DESC, ticker LIMIT 150) USING (ticker)""", "avg_value_traded fundamental_score", 4)
_ROLES = [("vix", "VIX", "view"), ("usdidr", "USD/IDR", "click"), ("sp500", "S&P 500", "purchase"), ("nikkei", "Nikkei 225", "signup")]
_MACRO = {
    **_LAST,
    "ticks": """SELECT event_type AS index_name, max(ts) AS ts, arg_max(value, ord) AS price FROM (
 SELECT *, row_number() OVER (ORDER BY ts, event_id) AS ord FROM events)
 WHERE event_type <> 'error' AND CAST(ts AS DATE) = (SELECT max(date) FROM index_bars) GROUP BY 1""",
    "live": """SELECT index_name, CASE WHEN price IS NULL THEN strftime(date, '%Y-%m-%d')
 ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS "timestamp", coalesce(price, close) AS value, price IS NOT NULL AS is_live
 FROM lastindex LEFT JOIN ticks USING (index_name)""",
    "roles": " UNION ALL ".join(
        f"SELECT {i} AS position, '{r}' AS role, '{n}' AS name, '{x}' AS index_name" for i, (r, n, x) in enumerate(_ROLES)),
    "valued": """SELECT r.*, CASE WHEN role = 'nikkei' THEN l."timestamp" ELSE strftime(x.date, '%Y-%m-%d') END AS "timestamp",
 CASE WHEN role = 'nikkei' THEN l.value ELSE x.close END AS value, role = 'nikkei' AND l.is_live AS is_live, previous, sma20
 FROM roles r JOIN lastindex x USING (index_name) JOIN live l USING (index_name)""",
    "macro": f"""SELECT position, role, name, "timestamp", value, is_live,
 (SELECT round_even(count(*) FILTER (close < v.value) / count(*) * 100, 2) FROM index_bars b
  WHERE b.index_name = v.index_name) AS percentile_rank,
 CASE WHEN role <> 'vix' THEN c END AS change_pct,
 CASE WHEN role = 'usdidr' THEN round_even(100 * (value - sma20) / sma20, 4) END AS vs_sma_20_pct,
 {', '.join(f"CASE role WHEN 'vix' THEN {vix(p, 'value')} WHEN 'usdidr' THEN {fx(p)} ELSE {index(p, 'name')} END AS {p}" for p in THREE)}
 FROM (SELECT *, round_even(100 * (value - previous) / previous, 4) AS c FROM valued) v""",
    "sentiments": """SELECT *, CASE sentiment WHEN 'Very Bearish' THEN -2e0 WHEN 'Bearish' THEN -1e0
 WHEN 'Slightly Bearish' THEN -0.5e0 WHEN 'Cautious' THEN -0.5e0 WHEN 'Slightly Bullish' THEN 0.5e0
 WHEN 'Bullish' THEN 1e0 ELSE 0e0 END AS points FROM macro""",
    "overall": """SELECT round_even(composite, 2) AS composite_score, outlook,
 parts || printf('. Composite score: %+.2f → Overall outlook: ', round(CAST(composite AS DECIMAL(18, 6)), 2)::DOUBLE)
 || outlook || '.' AS rationale FROM (
 SELECT *, CASE WHEN composite >= 0.5 THEN 'Bullish' WHEN composite >= 0 THEN 'Neutral-to-Bullish'
  WHEN composite >= -0.5 THEN 'Neutral-to-Bearish' ELSE 'Bearish' END AS outlook FROM (
  SELECT avg(points) AS composite,
   string_agg(name || ' is ' || sentiment || printf(' (score %+.1f)', points), ', ' ORDER BY position) AS parts
  FROM sentiments))""",
}
add("latest_price_with_fallback", "SELECT * FROM live", extra=_MACRO)
add("macro_outlook", "SELECT * FROM macro", "value percentile_rank change_pct vs_sma_20_pct", extra=_MACRO)
add("overall_outlook", "SELECT * FROM overall", extra=_MACRO)
_MICRO = {**_INDEX_SCORE, **{
    f"micro_{w}": described("median_gain", f"""ijoined_{w} WHERE avg_score >=
 (SELECT arg_max(avg_score, date) FROM averages)""") for w in (5, 10)}}
add("micro_outlook", 'SELECT *, 5 AS "window" FROM micro_5 UNION ALL SELECT *, 10 FROM micro_10', EIGHT, extra=_MICRO)
add("json_sink_outlook", "SELECT (SELECT CAST(max(date) AS VARCHAR) FROM index_bars) AS \"timestamp\", " + ", ".join(
    f"(SELECT {c} FROM macro WHERE role = '{r}') AS {r}_{c if c != 'tier' else 'tier'}"
    for r, _, _ in _ROLES for c in ("value", "percentile_rank", "tier"))
    + ", composite_score, outlook, " + ", ".join(
    f'(SELECT "{c}" FROM micro_{w}) AS micro_{w}_{c}' for w in (5, 10) for c in ("count", "mean")) + " FROM overall",
    [f"{r}_{c}" for r, _, _ in _ROLES for c in ("value", "percentile_rank")] + ["micro_5_mean", "micro_10_mean"],
    extra={**_MACRO, **_MICRO})
_TODAY = {"today": f"""SELECT *, {BIN} AS bin FROM (
 SELECT ticker, max(date) AS score_date, arg_max(score, date) AS score FROM scores GROUP BY ticker)""",
          "advice": """SELECT ticker, score_date, score, bin, close, buy_pct, sell_pct,
 CAST(floor(close * (100 - abs(buy_pct)) / 100) AS DOUBLE) AS target_buy_price,
 CAST(ceil(close * (100 + abs(sell_pct)) / 100) AS DOUBLE) AS target_sell_price
 FROM today JOIN (SELECT ticker, arg_max(close, date) AS close FROM bars GROUP BY ticker) USING (ticker)
 LEFT JOIN targets USING (bin)"""}
add("daily_recommendation", "SELECT * FROM advice", "score close buy_pct sell_pct", extra=_TODAY)
add("recommendation_records", """SELECT CAST(score_date AS VARCHAR) AS score_date, '5dd' AS rolling_window,
 CAST(ticker AS VARCHAR) AS ticker, score, target_buy_price, target_sell_price FROM advice""", extra=_TODAY)
add("performance_overview", " UNION ALL ".join(
    described(m, 'performance GROUP BY model_version, label_type, "window"',
              f"model_version, label_type, \"window\", '{m}' AS metric, ") for m in _SIDES), EIGHT)
