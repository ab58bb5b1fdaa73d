"""SQL counterparts of the indicators, recursive ones as recursive table expressions."""

from __future__ import annotations

from oracle.ctes import CTE, rounded, statement
from tickerloom.functions.naming import FEATURE_COLUMNS

W = "PARTITION BY ticker ORDER BY date"

CTE["b"] = f"""
SELECT *, row_number() OVER ({W}) AS rn, lag(close) OVER ({W}) AS pc, lag(high) OVER ({W}) AS ph,
       lag(low) OVER ({W}) AS pl FROM bars"""
CTE["deltas"] = """
SELECT *, CASE WHEN pc IS NOT NULL THEN greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
 CASE WHEN close > pc THEN close - pc ELSE 0 END AS gain, CASE WHEN close < pc THEN pc - close ELSE 0 END AS loss,
 CASE WHEN high - ph > pl - low AND high > ph THEN high - ph ELSE 0 END AS pdm,
 CASE WHEN pl - low > high - ph AND low < pl THEN pl - low ELSE 0 END AS mdm FROM b"""
CTE["arr"] = "SELECT ticker, " + ", ".join(
    f"list({c} ORDER BY date) AS a_{c}" for c in ("close", "tr", "gain", "loss", "pdm", "mdm")
) + " FROM deltas GROUP BY ticker"


def _ema(n):
    return (n, f"list_avg(s.a_close[1:{n}])", f"{{0}} + 2e0 / {n + 1} * (s.a_close[r.i + 1] - {{0}})")


def _wilder(x, n):
    return (n + 1, f"list_avg(s.a_{x}[2:{n + 1}])", f"({{0}} * {n - 1} + s.a_{x}[r.i + 1]) / {n}")


SMOOTHED = {
    "ema12": _ema(12), "ema13": _ema(13), "ema20": _ema(20), "ema26": _ema(26),
    "atr10": _wilder("tr", 10), "tr14": _wilder("tr", 14), "atr21": _wilder("tr", 21),
    "pdm14": _wilder("pdm", 14), "mdm14": _wilder("mdm", 14),
    **{f"{x}{n}": _wilder(x, n) for x in ("gain", "loss") for n in (7, 14, 21)},
}


def smoothed(*names):
    """Rows (ticker, i, names...) by one recursion over the row number."""
    start = ", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in names)
    steps = []
    for n in names:
        first, seed, update = SMOOTHED[n]
        steps.append(f"CASE WHEN r.i + 1 = {first} THEN {seed} WHEN r.i + 1 > {first} THEN "
                     f"{update.format('r.' + n)} END")
    return {
        "rec": f"""SELECT ticker, 0 AS i, {start} FROM arr
UNION ALL SELECT r.ticker, r.i + 1, {', '.join(steps)}
FROM rec r JOIN arr s ON s.ticker = r.ticker WHERE r.i < len(s.a_close)""",
        "rb": "SELECT b.*, " + ", ".join(f"rec.{n}" for n in names)
              + " FROM b JOIN rec ON rec.ticker = b.ticker AND rec.i = b.rn",
    }


def trend(source, columns, n):
    """``source`` with frame sums of the columns over the previous n rows."""
    f = f"OVER ({W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    parts = []
    for c in columns:
        parts.append(f"count({c}) {f} AS {c}_m, sum({c}) {f} AS {c}_s, sum({c} * rn) {f} AS {c}_k, "
                     f"max({c}) {f} AS {c}_hi, min({c}) {f} AS {c}_lo, "
                     f"count({c}) OVER ({W} ROWS UNBOUNDED PRECEDING) AS {c}_place")
    return f"(SELECT *, {', '.join(parts)} FROM {source})"


def slope_flag(c, n, op, place=None):
    slope = f"{c}_k - (rn - ({c}_m + 1) / 2e0) * {c}_s"
    noise = f"1e-13 * {n} * rn * greatest(abs({c}_hi), abs({c}_lo))"
    beyond = f"{slope} > {noise}" if op == ">" else f"{slope} < -{noise}"
    return (f"CASE WHEN {place or c + '_place'} > {n} THEN "
            f"CASE WHEN {c}_hi > {c}_lo AND {beyond} THEN 1e0 ELSE 0e0 END END")


def both(c, up, down, n=5, place=None):
    return f"{slope_flag(c, n, '>', place)} AS {up}, {slope_flag(c, n, '<', place)} AS {down}"


def i(condition):
    return f"CAST({condition} AS INTEGER)"


def roll(agg, n, end="CURRENT ROW", start=None):
    return f"{agg} OVER ({W} ROWS BETWEEN {n - 1 if start is None else start} PRECEDING AND {end})"


MFV = "(CASE WHEN high = low THEN 0e0 ELSE ((close - low) - (high - close)) / (high - low) END) * volume"

IND: dict[str, tuple[str, dict, str]] = {}  # name -> body, extra expressions, rounded columns

IND["atr_stop"] = (
    f"SELECT ticker, date, {i('stop >= close')} AS atr_bullish, {i('stop < close')} AS atr_bearish FROM ("
    "SELECT rb.ticker, rb.date, rb.close, CASE WHEN rising THEN lower_band ELSE upper_band END AS stop "
    "FROM rb JOIN stops ON stops.ticker = rb.ticker AND stops.i = rb.rn)",
    {
        **smoothed("atr21"),
        "arr_stop": "SELECT ticker, list(close ORDER BY date) AS c, list(3 * atr21 ORDER BY date) AS w "
                    "FROM rb GROUP BY ticker",
        "stops": """
SELECT ticker, 22 AS i, c[22] >= c[21] AS rising, c[22] + w[22] AS upper_band, c[22] - w[22] AS lower_band
FROM arr_stop WHERE len(c) >= 22
UNION ALL
SELECT ticker, i, close > CASE WHEN rising THEN lower_band ELSE upper_band END, upper_band, lower_band FROM (
 SELECT s.ticker, s.i + 1 AS i, s.rising, a.c[s.i + 1] AS close,
  CASE WHEN a.c[s.i + 1] + a.w[s.i + 1] < s.upper_band OR a.c[s.i] > s.upper_band
       THEN a.c[s.i + 1] + a.w[s.i + 1] ELSE s.upper_band END AS upper_band,
  CASE WHEN a.c[s.i + 1] - a.w[s.i + 1] > s.lower_band OR a.c[s.i] < s.lower_band
       THEN a.c[s.i + 1] - a.w[s.i + 1] ELSE s.lower_band END AS lower_band
 FROM stops s JOIN arr_stop a ON a.ticker = s.ticker WHERE s.i < len(a.c))""",
    }, "")

IND["aroon"] = (
    f"""SELECT ticker, date, {i(f'(up >= down) <> lag(up >= down) OVER ({W})')} AS aroon_change_position,
 {i('up >= 70')} AS aroon_up_trend, {i('down >= 70')} AS aroon_down_trend FROM (
 SELECT *, 100 * (25 - (rn - list_extract(tops, 2))) / 25e0 AS up, 100 * (25 - (rn - list_extract(lows, 2))) / 25e0 AS down
 FROM (SELECT *, {roll('max([high, -rn])', 26)} AS t, {roll('min([low, rn])', 26)} AS lows,
       [list_extract(t, 1), -list_extract(t, 2)] AS tops FROM b) WHERE rn >= 26)""", {}, "")

IND["adx"] = (
    f"""SELECT ticker, date, {i('p <= 25')} AS weak_plus_directional_index, {i('p > 25')} AS strong_plus_directional_index,
 {i('m <= 25')} AS weak_minus_directional_index, {i('m > 25')} AS strong_minus_directional_index FROM (
 SELECT *, 100 * pdm14 / nullif(tr14, 0) AS p, 100 * mdm14 / nullif(tr14, 0) AS m FROM rb)
 WHERE p IS NOT NULL AND m IS NOT NULL""", smoothed("tr14", "pdm14", "mdm14"), "")

_share10 = f"OVER ({W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)"
IND["elder_ray"] = (
    f"""SELECT ticker, date, {slope_flag('bull', 10, '>')} AS bull_power_up_trend,
 CASE WHEN bull_place > 10 THEN CASE WHEN count(*) FILTER (bull > 0) {_share10} >= 8 THEN 1e0 ELSE 0e0 END END
   AS bull_power_80_pct_positives,
 {slope_flag('bear', 10, '<')} AS bear_power_trend,
 CASE WHEN bear_place > 10 THEN CASE WHEN count(*) FILTER (bear < 0) {_share10} >= 8 THEN 1e0 ELSE 0e0 END END
   AS bear_power_80_pct_negatives
 FROM {trend('(SELECT *, high - ema13 AS bull, low - ema13 AS bear FROM rb WHERE ema13 IS NOT NULL)', ['bull', 'bear'], 10)}""",
    smoothed("ema13"), "")

IND["macd"] = (
    f"""SELECT ticker, date, {i('abs(h) < thr')} AS macd_near_0, {i('h <= -thr')} AS macd_non_near_0_negative,
 {i('h >= thr')} AS macd_non_near_0_positive FROM (
 SELECT *, {roll('quantile_cont(abs(h), 0.5)', 50)} AS thr FROM (
  SELECT rb.*, ema12 - ema26 - sig.e AS h FROM rb JOIN sig ON sig.ticker = rb.ticker AND sig.i + 25 = rb.rn))""",
    {
        **smoothed("ema12", "ema26"),
        "arr_macd": "SELECT ticker, list(ema12 - ema26 ORDER BY date) AS m FROM rb WHERE rn >= 26 GROUP BY ticker",
        "sig": """SELECT ticker, 9 AS i, list_avg(m[1:9]) AS e FROM arr_macd WHERE len(m) >= 9
UNION ALL SELECT s.ticker, s.i + 1, s.e + 2e0 / 10 * (a.m[s.i + 1] - s.e)
FROM sig s JOIN arr_macd a ON a.ticker = s.ticker WHERE s.i < len(a.m)""",
    }, "")


def _channel(name, source, extra):
    body = f"""SELECT ticker, date, (close - lo) / nullif(up - lo, 0) AS {name}_percent_b,
 {i('up <= close')} AS {name}_overbought, {i('lo >= close')} AS {name}_oversold,
 {both('width', f'width_{name}_increasing', f'width_{name}_decreasing', place='rn')}
 FROM {trend(source, ['width'], 5)} WHERE up IS NOT NULL AND width IS NOT NULL"""
    return body, extra, f"{name}_percent_b"


IND["keltner"] = _channel(
    "keltner", "(SELECT *, (up - lo) / nullif(ema20, 0) AS width FROM "
    "(SELECT *, ema20 + 2 * atr10 AS up, ema20 - 2 * atr10 AS lo FROM rb))", smoothed("ema20", "atr10"))
IND["donchian"] = _channel(
    "donchian", "(SELECT *, (up - lo) / nullif((up + lo) / 2, 0) AS width FROM (SELECT *, "
    f"CASE WHEN rn > 20 THEN {roll('max(high)', 20, '1 PRECEDING', 20)} END AS up, "
    f"CASE WHEN rn > 20 THEN {roll('min(low)', 20, '1 PRECEDING', 20)} END AS lo FROM b))", {})
IND["bollinger"] = _channel(
    "bollinger", "(SELECT *, (up - lo) / nullif(sma, 0) AS width FROM (SELECT *, sma + 2 * sd AS up, sma - 2 * sd AS lo "
    f"FROM (SELECT *, CASE WHEN rn >= 20 THEN {roll('avg(close)', 20)} END AS sma, "
    f"CASE WHEN rn >= 20 THEN {roll('stddev_pop(close)', 20)} END AS sd FROM b)))", {})


def _rsi(n):
    return f"CASE WHEN loss{n} > 0 THEN 100 - 100 / (1 + gain{n} / loss{n}) WHEN gain{n} IS NOT NULL THEN 100e0 END"


IND["rsi"] = (
    f"""SELECT ticker, date, r AS rsi_value, {i('r >= 65')} AS rsi_up_trend, {i('r <= 35')} AS rsi_down_trend,
 r - lag(r, 5) OVER ({W}) AS rsi_rate_of_change_5, r - lag(r, 10) OVER ({W}) AS rsi_rate_of_change_10
 FROM (SELECT *, {_rsi(14)} AS r FROM rb) WHERE r IS NOT NULL""",
    smoothed("gain14", "loss14"), "rsi_value rsi_rate_of_change_5 rsi_rate_of_change_10")
IND["rsi_multi"] = (
    f"""SELECT coalesce(a.ticker, c.ticker) AS ticker, coalesce(a.date, c.date) AS date, rsi_7, rsi_21
 FROM (SELECT ticker, date, {_rsi(7)} AS rsi_7 FROM rb WHERE gain7 IS NOT NULL) a
 FULL JOIN (SELECT ticker, date, {_rsi(21)} AS rsi_21 FROM rb WHERE gain21 IS NOT NULL) c
 ON a.ticker = c.ticker AND a.date = c.date""",
    smoothed("gain7", "loss7", "gain21", "loss21"), "rsi_7 rsi_21")
IND["stochastic"] = (
    f"""SELECT ticker, date, o AS stochastic_k_value, CASE WHEN o >= 80 THEN 1e0 ELSE 0e0 END AS stochastic_oscillator_overbought,
 CASE WHEN o <= 20 THEN 1e0 ELSE 0e0 END AS stochastic_oscillator_oversold FROM (
 SELECT *, CASE WHEN rn >= 16 THEN {roll('avg(k)', 3)} END AS o FROM (
  SELECT *, CASE WHEN rn < 14 THEN NULL WHEN hh = ll THEN 0e0 ELSE 100 * (close - ll) / (hh - ll) END AS k FROM (
   SELECT *, {roll('max(high)', 14)} AS hh, {roll('min(low)', 14)} AS ll FROM b))) WHERE o IS NOT NULL""",
    {}, "stochastic_k_value")
IND["obv"] = (
    f"""SELECT ticker, date, {both('obv', 'on_balance_volume_increasing', 'on_balance_volume_decreasing')},
 obv / nullif(CASE WHEN rn >= 20 THEN {roll('avg(obv)', 20)} END, 0) AS obv_to_ma20_ratio
 FROM {trend(f"(SELECT *, sum(coalesce(sign(close - pc) * volume, 0e0)) OVER ({W} ROWS UNBOUNDED PRECEDING) AS obv FROM b)", ['obv'], 5)}""",
    {}, "obv_to_ma20_ratio")
IND["adl"] = (
    f"""SELECT ticker, date, {both('adl', 'accumulation_distribution_line_increasing',
                                   'accumulation_distribution_line_decreasing')}
 FROM {trend(f"(SELECT *, CAST(sum(CAST({MFV} AS DECIMAL(28, 12))) OVER ({W} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS adl FROM b)", ['adl'], 5)}""", {}, "")
IND["cmf"] = (
    f"""SELECT ticker, date, {i('f > 0')} AS positive_cmf, {i('f >= 0.25')} AS strong_positive_cmf,
 {i('f <= 0')} AS negative_cmf, {i('f <= -0.25')} AS strong_negative_cmf,
 {i(f'f * lag(f) OVER ({W}) <= 0')} AS crossover_cmf FROM (
 SELECT *, CASE WHEN rn >= 20 THEN {roll('sum(mfv)', 20)} / nullif({roll('sum(volume)', 20)}, 0) END AS f
 FROM (SELECT *, {MFV} AS mfv FROM b)) WHERE f IS NOT NULL""", {}, "")
IND["mfi"] = (
    f"""SELECT ticker, date, mfi AS mfi_value, {i('mfi >= 80')} AS mfi_overbought, {i('mfi <= 20')} AS mfi_oversold,
 {both('mfi', 'mfi_increasing', 'mfi_decreasing')}
 FROM {trend(f'''(SELECT *, CASE WHEN fall = 0 THEN 100e0 ELSE 100 - 100 / (1 + rise / fall) END AS mfi FROM (
  SELECT *, {roll('sum(CASE WHEN tp > ptp THEN tp * volume ELSE 0e0 END)', 14)} AS rise,
         {roll('sum(CASE WHEN tp < ptp THEN tp * volume ELSE 0e0 END)', 14)} AS fall FROM (
   SELECT *, (high + low + close) / 3 AS tp, (ph + pl + pc) / 3 AS ptp FROM b)) WHERE rn >= 15)''', ['mfi'], 5)}""",
    {}, "mfi_value")
IND["fisher"] = (
    f"""SELECT ticker, date, {i('f >= 2')} AS fisher_up_trend, {i('f <= -2')} AS fisher_down_trend,
 {i(f'(f >= t) <> lag(f >= t) OVER ({W})')} AS fisher_reversal FROM (
 SELECT b.ticker, b.date, b.rn, fish.f, lag(fish.f) OVER (PARTITION BY b.ticker ORDER BY b.date) AS t
 FROM b JOIN fish ON fish.ticker = b.ticker AND fish.i = b.rn) WHERE rn >= 2""",
    {
        "arr_fish": f"""SELECT ticker, list(CASE WHEN hi > lo THEN (m - lo) / (hi - lo) - 0.5 END ORDER BY date) AS p
FROM (SELECT *, {roll('max(m)', 10)} AS hi, {roll('min(m)', 10)} AS lo
      FROM (SELECT *, (high + low) / 2 AS m FROM b)) GROUP BY ticker""",
        "fish": """SELECT ticker, 1 AS i, 0e0 AS x, 0e0 AS f FROM arr_fish
UNION ALL
SELECT ticker, i, x, 0.5e0 * ln((1 + x) / (1 - x)) + 0.5e0 * f FROM (
 SELECT ticker, i, f, CASE WHEN y > 0.99 THEN 0.999e0 WHEN y < -0.99 THEN -0.999e0 ELSE y END AS x FROM (
  SELECT s.ticker, s.i + 1 AS i, s.f,
   CASE WHEN a.p[s.i + 1] IS NULL THEN 0e0 ELSE 0.66e0 * a.p[s.i + 1] + 0.67e0 * s.x END AS y
  FROM fish s JOIN arr_fish a ON a.ticker = s.ticker WHERE s.i < len(a.p)))""",
    }, "")
# Turning points one after another: the first one is the first bar, the next is the latest extreme before a reversal.
_TURNS = {
    "turn_start": """SELECT ticker, 1 AS rn, CASE WHEN arg_min(close, rn) > any_value(c0) THEN -1 ELSE 1 END AS side
FROM (SELECT *, first_value(close) OVER (PARTITION BY ticker ORDER BY date) AS c0 FROM b)
WHERE abs(close - c0) >= 0.05 * c0 GROUP BY ticker""",
    "turns": """SELECT ticker, rn, side, 0 AS n FROM turn_start
UNION ALL
SELECT ticker, arg_max(rn, {'h': h, 'rn': rn}), -any_value(side), any_value(n) + 1 FROM (
 SELECT *, min(CASE WHEN best - h >= 0.05 * abs(best) THEN rn END) OVER (PARTITION BY ticker) AS gone FROM (
  SELECT r.ticker, r.side, r.n, b.rn, b.close * -r.side AS h,
   max(b.close * -r.side) OVER (PARTITION BY r.ticker ORDER BY b.rn) AS best
  FROM turns r JOIN b ON b.ticker = r.ticker AND b.rn >= r.rn))
WHERE rn < gone GROUP BY ticker""",
    "corners": """SELECT b.ticker, b.rn, b.close, t.side FROM b JOIN turns t ON t.ticker = b.ticker AND t.rn = b.rn WHERE t.n > 0
UNION ALL SELECT b.ticker, b.rn, b.close, 0 FROM b JOIN (SELECT ticker, max(rn) AS rn FROM b GROUP BY ticker) e
 ON e.ticker = b.ticker AND e.rn = b.rn""",
    "zz": f"""SELECT *, CASE WHEN y1 IS NULL THEN y0 ELSE (y1 - y0) / (x1 - x0) * (rn - x0) + y0 END AS zigzag FROM (
 SELECT b.*, coalesce(c.side, 0) AS point, last_value(c.rn IGNORE NULLS) OVER w AS x0, last_value(c.close IGNORE NULLS) OVER w AS y0,
  first_value(c.rn IGNORE NULLS) OVER v AS x1, first_value(c.close IGNORE NULLS) OVER v AS y1
 FROM b LEFT JOIN (SELECT ticker, rn, any_value(close) AS close, max(side) + min(side) AS side FROM corners GROUP BY ticker, rn) c
  ON c.ticker = b.ticker AND c.rn = b.rn
 WINDOW w AS (PARTITION BY b.ticker ORDER BY b.date ROWS UNBOUNDED PRECEDING),
  v AS (PARTITION BY b.ticker ORDER BY b.date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))""",
}
IND["zigzag"] = (
    f"""SELECT ticker, date, {both('zigzag', 'zig_zag_increasing', 'zig_zag_decreasing')},
 {i('point > 0')} AS zig_zag_high, {i('point < 0')} AS zig_zag_low
 FROM {trend('zz', ['zigzag'], 5)} WHERE zigzag IS NOT NULL""", _TURNS, "")
IND["momentum"] = (
    f"""SELECT ticker, date, {', '.join(f'close / lag(close, {n}) OVER ({W}) - 1 AS price_momentum_{n}d' for n in (5, 10, 20))},
 volume / nullif(CASE WHEN rn >= 20 THEN {roll('avg(volume)', 20)} END, 0) AS volume_ratio_20d FROM b""",
    {}, "price_momentum_5d price_momentum_10d price_momentum_20d volume_ratio_20d")


def _flow():
    base = """(SELECT ticker, date, (open + high + low + close) / 4 AS px, foreign_buy - foreign_sell AS nf,
 volume - (foreign_buy + foreign_sell) AS nd, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn
 FROM bars JOIN flow USING (ticker, date))"""
    sums, feats, names = [], [], []
    for n in (15, 60, 90):
        def total(x):
            return f"CASE WHEN rn >= {n} THEN {roll(f'sum({x})', n)} END"
        sums.append(f"{total('nf')} AS f{n}, {total('nd')} AS d{n}, {total('px * nf')} AS fv{n}, {total('px * nd')} AS dv{n}")
        for name, expr in (
            (f"foreign_to_domestic_{n}_days_ownership", f"f{n} / nullif(f{n} + d{n}, 0)"),
            (f"foreign_{n}_days_average_price_over_current_price", f"(fv{n} / nullif(f{n}, 0) - px) / px"),
            (f"domestic_{n}_days_average_price_over_current_price", f"(dv{n} / nullif(d{n}, 0) - px) / px"),
        ):
            feats.append(f"lag({expr}) OVER ({W}) AS {name}")
            names.append(name)
    return f"SELECT ticker, date, {', '.join(feats)} FROM (SELECT *, {', '.join(sums)} FROM {base})", {}, " ".join(names)


IND["flow"] = _flow()


def sql(name):
    body, extra, doubles = IND[name]
    return statement(rounded(body, doubles, 4) if doubles else body, extra)


def everything(leave_out=("zigzag",)):
    """Body, table expressions and rounded columns of the indicators joined to the bars, without the repainting one."""
    parts, extra, doubles = [], {}, []
    names = sorted({x for name in IND for x in _series_of(name)})
    extra.update(smoothed(*names))
    for name, (body, own, cols) in IND.items():
        if name in leave_out:
            continue
        extra.update({k: v for k, v in own.items() if k not in ("rec", "rb")})
        extra[f"ind_{name}"] = body
        doubles += cols.split()
        parts.append(f"LEFT JOIN ind_{name} USING (ticker, date)")
    return "SELECT * FROM (SELECT ticker, date FROM bars) " + " ".join(parts), extra, doubles


def complete():
    """Bars and all features under their published names, complete rows only: body, table expressions, doubles."""
    body, extra, doubles = everything(())
    shown = ", ".join(f'{name} AS "{FEATURE_COLUMNS[name]}"' for name in FEATURE_COLUMNS)
    known = " AND ".join(f"{name} IS NOT NULL" for name in FEATURE_COLUMNS)
    extra["featured"] = f"SELECT bars.*, {shown} FROM bars JOIN ({body}) USING (ticker, date) WHERE {known}"
    return extra, [FEATURE_COLUMNS[d] for d in doubles]


def _series_of(name):
    rec = IND[name][1].get("rec", "")
    return [n for n in SMOOTHED if f" AS {n}" in rec]


SQL = {f"ind_{name}": sql(name) for name in IND}
SQL["rsi_outer_join"] = statement(rounded(IND["rsi_multi"][0], "rsi_7 rsi_21", 6), IND["rsi_multi"][1])
_BODY, _EXTRA, _DOUBLES = everything()
SQL["assemble_features"] = statement(rounded(_BODY, _DOUBLES, 4), _EXTRA)
FEATURED, FEATURED_DOUBLES = complete()
SQL["feature_table"] = statement(
    rounded("SELECT * FROM featured", FEATURED_DOUBLES + ["open", "high", "low", "close"], 4), FEATURED)
SQL["feature_list"] = statement(" UNION ALL ".join(
    f"SELECT {i} AS position, '{name}' AS feature, count(*) FILTER (abs(\"{name}\") > 1e-9) AS nonzero FROM featured"
    for i, name in enumerate(sorted(FEATURE_COLUMNS.values()))), FEATURED)
