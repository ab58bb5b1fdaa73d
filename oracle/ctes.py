"""Shared table expressions of the SQL counterparts, and how a statement is put together."""

from __future__ import annotations

import re

CTE: dict[str, str] = {}

CTE["trades"] = """
SELECT l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS price,
       l_quantity AS quantity, l_extendedprice AS value, l_returnflag AS side, l_linestatus AS board,
       l_discount AS discount, l_tax AS tax,
       row_number() OVER (PARTITION BY l_suppkey, l_shipdate
                          ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS seq
FROM lineitem"""

CTE["bars"] = """
SELECT ticker, date, arg_min(price, seq) AS open, max(price) AS high, min(price) AS low,
       arg_max(price, seq) AS close, sum(quantity) AS volume
FROM trades GROUP BY ticker, date"""

CTE["flow"] = """
SELECT ticker, date,
       sum(CASE WHEN side = 'A' THEN quantity ELSE 0 END) AS foreign_sell,
       sum(CASE WHEN side = 'R' THEN quantity ELSE 0 END) AS foreign_buy,
       sum(CASE WHEN board = 'F' THEN quantity ELSE 0 END) AS non_regular_volume,
       sum(CASE WHEN board = 'F' THEN value ELSE 0 END) AS non_regular_value,
       CAST(count(*) FILTER (board = 'F') AS DOUBLE) AS non_regular_frequency
FROM trades WHERE side IN ('A', 'R') GROUP BY ticker, date"""

CTE["landings"] = """
SELECT *, 0 AS landing FROM flow
UNION ALL
SELECT * REPLACE (foreign_buy + 1 AS foreign_buy), 1 AS landing FROM flow WHERE foreign_buy > 0"""

CTE["snapshots"] = """
SELECT *, replace(replace(replace(replace(strftime(date, '%d %b %Y'),
       'May', 'Mei'), 'Aug', 'Agt'), 'Oct', 'Okt'), 'Dec', 'Des') AS text
FROM landings"""

CTE["industry"] = """
SELECT s_suppkey AS ticker, n_name AS industry FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

CTE["fundamentals"] = """
SELECT s_suppkey AS ticker,
 CASE WHEN s_suppkey % 7 <> 0 THEN 5e0 + (s_suppkey * 13 % 40) END AS "trailingPE",
 CASE WHEN s_suppkey % 5 <> 0 THEN 4e0 + (s_suppkey * 11 % 35) END AS "forwardPE",
 CASE WHEN s_suppkey % 3 <> 0 THEN (s_suppkey * 29 % 50) / 10e0 END AS "pegRatio",
 CASE WHEN s_suppkey % 11 <> 0 THEN (s_suppkey * 17 % 60) / 10e0 END AS "priceToBook",
 s_acctbal / 10000e0 AS "returnOnEquity",
 s_acctbal / 20000e0 AS "returnOnAssets",
 CASE WHEN s_suppkey % 17 <> 0 THEN (s_suppkey * 37 % 150) / 100e0 - 0.6e0 END AS "profitMargins",
 CASE WHEN s_suppkey % 19 <> 0 THEN (s_suppkey * 41 % 150) / 100e0 - 0.6e0 END AS "operatingMargins",
 CASE WHEN s_suppkey % 6 <> 1 THEN CAST(s_suppkey * 43 % 400 AS DOUBLE) END AS "debtToEquity",
 CASE WHEN s_suppkey % 8 <> 1 THEN (s_suppkey * 23 % 50) / 10e0 END AS "currentRatio",
 CASE WHEN s_suppkey % 9 <> 1 THEN (s_suppkey * 19 % 40) / 10e0 END AS "quickRatio",
 CASE WHEN s_suppkey % 10 <> 1 THEN s_acctbal * (1000e0 + (s_suppkey * 7 % 100)) END AS "freeCashflow",
 CASE WHEN s_suppkey % 12 <> 1 THEN s_acctbal * (1200e0 + (s_suppkey * 3 % 100)) END AS "operatingCashflow",
 CASE WHEN s_suppkey % 14 <> 1 THEN (s_suppkey * 31 % 300) / 100e0 - 0.8e0 END AS "revenueGrowth",
 CASE WHEN s_suppkey % 15 <> 1 THEN (s_suppkey * 47 % 300) / 100e0 - 0.8e0 END AS "earningsGrowth",
 qty AS "averageVolume", qty / 10e0 AS "volume",
 CASE WHEN s_suppkey % 13 = 0 THEN 0e0 ELSE 100000000e0 + (s_suppkey * 53 % 1000) * 1000000e0 END AS "marketCap",
 value * 157e0 / qty AS "regularMarketPrice"
FROM supplier JOIN (SELECT l_suppkey, sum(l_quantity) AS qty, sum(l_extendedprice) AS value
                    FROM lineitem GROUP BY 1) ON s_suppkey = l_suppkey"""


def _bounded(expr, low=None, high=None):
    out = expr
    if high is not None:
        out = f"least({out}, {high}e0)"
    if low is not None:
        out = f"greatest({out}, {low}e0)"
    return out


def _pct(name, high):
    return _bounded(f'coalesce("{name}", -1e0) * 100', -50, high)


def _inv(name, weight, floor, cap):
    return _bounded(f'{weight}e0 / greatest(coalesce("{name}", 999e0), {floor}e0)', high=cap)


def _cash(name):
    share = f'CASE WHEN coalesce("marketCap", 0) > 0 THEN coalesce("{name}", 0) / "marketCap" * 100 END'
    return _bounded(f"coalesce({share}, -50e0) * 10", -50, 100)


TRADED = 'coalesce("averageVolume", 0) * coalesce("regularMarketPrice", 0)'
PARTS = {
    "profitability": f"{_pct('returnOnEquity', 80)} + {_pct('returnOnAssets', 80)} + "
                     f"{_pct('profitMargins', 70)} + {_pct('operatingMargins', 70)}",
    "growth": f"{_pct('revenueGrowth', 150)} + {_pct('earningsGrowth', 150)}",
    "valuation": f"{_inv('pegRatio', 50, 0.1, 100)} + {_inv('forwardPE', 200, 1, 75)} + "
                 f"{_inv('trailingPE', 200, 1, 75)} + {_inv('priceToBook', 25, 0.1, 50)}",
    "health": 'least(coalesce("currentRatio", 0) * 20, 50e0) + least(coalesce("quickRatio", 0) * 25, 50e0) + '
              + _bounded('200 - coalesce("debtToEquity", 999e0)', -50, 100),
    "cashflow": f"{_cash('freeCashflow')} + {_cash('operatingCashflow')}",
    "liquidity": _bounded(f"(log10(greatest({TRADED}, 1e0)) - log10(5e9)) * 50", -100, 200),
}
CTE["scored"] = f"""
SELECT *, {TRADED} AS avg_value_traded,
       {' + '.join(f'({p})' for p in PARTS.values())}
       + CASE WHEN {TRADED} < 5e9 THEN -10000e0 ELSE 0e0 END AS fundamental_score
FROM fundamentals"""
CTE["liquid"] = """
SELECT ticker, avg_value_traded, fundamental_score FROM scored
WHERE avg_value_traded >= (SELECT quantile_cont(avg_value_traded, 0.75) FROM scored)"""

CTE["index_bars"] = """
SELECT event_type AS index_name, CAST(ts AS DATE) AS date, arg_max(value, ord) AS close
FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS ord FROM events) GROUP BY 1, 2"""
CTE["market_index"] = """
SELECT 'IHSG' AS index_name, date, sum(close * volume) / sum(volume) AS close FROM bars GROUP BY date"""


def score(a, b):
    return f"((ticker * {a} + (date - DATE '1995-01-01') * {b}) % 1000) / 1000e0"


CTE["scores"] = f"SELECT ticker, date, {score(31, 17)} AS score FROM bars"
CTE["forecasts"] = " UNION ALL ".join(
    f"SELECT ticker, date, {v} AS model_version, '{label}' AS label_type, {w} AS \"window\", "
    f"{score(31 + v, 17 + w + shift)} AS p FROM bars"
    + (" WHERE ticker IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)" if v == 3 else "")
    for v in (1, 2, 3) for label, shift in (("median_gain", 0), ("median_loss", 3)) for w in (5, 10)
)

CTE["stacked_forecasts"] = " UNION ALL ".join(
    f"SELECT ticker, date, 4 AS model_version, 'median_gain' AS label_type, {w} AS \"window\", {score(35, 17 + w)} AS p FROM bars"
    for w in (5, 10)
)


def _ahead(w):
    f = f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND {w} FOLLOWING)"
    return f"CASE WHEN count(close) {f} = {w} THEN quantile_cont(close, 0.4) {f} END AS ahead_{w}"


CTE["aheads"] = f"""
SELECT ticker, date, close, {_ahead(5)}, {_ahead(10)},
       row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS age FROM bars"""
CTE["moves"] = """
SELECT *, 100 * (ahead_5 - close) / close AS move_5, 100 * (ahead_10 - close) / close AS move_10 FROM aheads"""
CTE["limits"] = "SELECT ticker, " + ", ".join(
    f"quantile_cont(move_{w}, {q}) FILTER (age BETWEEN {w + 1} AND {w + 80}) AS {kind}_{w}"
    for w in (5, 10) for kind, q in (("gain", 0.9), ("loss", 0.1))
) + " FROM moves GROUP BY ticker"
CTE["labelled"] = "SELECT m.ticker, m.date, m.close, " + ", ".join(
    f"{kind}_{w} AS \"Threshold Median {title} {w}dd\", "
    f"CASE WHEN move_{w} IS NULL THEN NULL WHEN move_{w} {op} {kind}_{w} THEN 'High {title}' "
    f"ELSE 'Low {title}' END AS \"Median {title} {w}dd\""
    for w in (5, 10) for kind, title, op in (("gain", "Gain", ">="), ("loss", "Loss", "<="))
) + " FROM moves m JOIN limits USING (ticker)"

for _w in (5, 10):
    CTE[f"dates_{_w}"] = f"""
SELECT date, row_number() OVER (ORDER BY date DESC) AS age
FROM (SELECT DISTINCT date FROM moves WHERE move_{_w} IS NOT NULL)"""
    CTE[f"splits_{_w}"] = f"""
SELECT min(date) FILTER (age > 120) AS train_start, max(date) FILTER (age > 120) AS train_end,
       min(date) FILTER (age BETWEEN 81 AND 120) AS val_start, max(date) FILTER (age BETWEEN 81 AND 120) AS val_end,
       min(date) FILTER (age <= 80) AS test_start, max(date) FILTER (age <= 80) AS test_end
FROM dates_{_w}"""

SPLIT = """CASE WHEN date BETWEEN train_start AND train_end THEN 'train'
     WHEN date BETWEEN val_start AND val_end THEN 'val'
     WHEN date BETWEEN test_start AND test_end THEN 'test'
     WHEN date > test_end THEN 'forecast' END"""
TRAIN_OR_TEST = """CASE WHEN date BETWEEN test_start AND test_end THEN 'test'
     WHEN date BETWEEN train_start AND val_end THEN 'train' END"""

CTE["predictions"] = f"""
SELECT * FROM (
 SELECT ticker, date, "Median Gain 5dd" AS y_true,
        CASE WHEN {score(31, 17)} >= 0.9 THEN 'High Gain' ELSE 'Low Gain' END AS y_pred,
        {score(31, 17)} AS p, {TRAIN_OR_TEST} AS split, "Threshold Median Gain 5dd" AS threshold
 FROM labelled, splits_5 WHERE "Median Gain 5dd" IS NOT NULL)
WHERE split IS NOT NULL"""


def metric_columns(positive, negative):
    """Aggregates of one group; the Gini comes from mid-ranks ``r``."""
    def share(hit, base):
        return f"coalesce(count(*) FILTER ({hit} AND {base}) / nullif(count(*) FILTER ({base}), 0), 0e0)"

    pos = f"count(*) FILTER (y_true = '{positive}')"
    neg = f"count(*) FILTER (y_true <> '{positive}')"
    right = "y_true = y_pred"
    return f"""avg(CASE WHEN {right} THEN 1e0 ELSE 0e0 END) AS accuracy,
 {share(right, f"y_pred = '{positive}'")} AS precision_positive,
 {share(right, f"y_pred = '{negative}'")} AS precision_negative,
 {share(right, f"y_true = '{positive}'")} AS recall_positive,
 {share(right, f"y_true = '{negative}'")} AS recall_negative,
 coalesce(2 * ((sum(r) FILTER (y_true = '{positive}') - {pos} * ({pos} + 1) / 2e0)
          / nullif({pos} * {neg}, 0)) - 1, 0e0) AS gini"""


def ranked(source, keys):
    return f"""SELECT *, rank() OVER (PARTITION BY {keys} ORDER BY p)
 + (count(*) OVER (PARTITION BY {keys}, p) - 1) / 2e0 AS r FROM {source}"""


CTE["ranked_predictions"] = ranked("predictions", "ticker, split")
CTE["metrics"] = f"""
SELECT ticker, split, {metric_columns('High Gain', 'Low Gain')} FROM ranked_predictions GROUP BY ticker, split"""
METRICS = ("accuracy", "precision_positive", "precision_negative", "recall_positive", "recall_negative", "gini")
SIDES = ", ".join(
    f"max({m}) FILTER (split = '{side}') AS {side}_{m}" for side in ("train", "test") for m in METRICS)
CTE["gain_performance"] = f"""
SELECT ticker, {SIDES}, any_value(threshold) AS threshold
FROM metrics JOIN (SELECT ticker, arg_min(threshold, date) AS threshold FROM predictions GROUP BY ticker)
USING (ticker) GROUP BY ticker"""

CTE["truth"] = " UNION ALL ".join(
    f"""SELECT ticker, date, 'median_{kind}' AS label_type, {w} AS "window",
 CASE WHEN "Median {title} {w}dd" LIKE 'High%' THEN 'positive' ELSE 'negative' END AS y_true,
 "Threshold Median {title} {w}dd" AS threshold, {TRAIN_OR_TEST} AS split
 FROM labelled, splits_{w} WHERE "Median {title} {w}dd" IS NOT NULL"""
    for w in (5, 10) for kind, title in (("gain", "Gain"), ("loss", "Loss")))
CTE["judged"] = """
SELECT f.*, y_true, threshold, split, CASE WHEN p >= 0.9 THEN 'positive' ELSE 'negative' END AS y_pred
FROM (SELECT * FROM forecasts UNION ALL SELECT * FROM stacked_forecasts) f
JOIN truth USING (ticker, date, label_type, "window") WHERE split IS NOT NULL"""
GROUP = 'ticker, model_version, label_type, "window"'
CTE["ranked_judged"] = ranked("judged", GROUP + ", split")
CTE["judged_metrics"] = f"""
SELECT {GROUP}, split, {metric_columns('positive', 'negative')} FROM ranked_judged GROUP BY {GROUP}, split"""
CTE["performance"] = f"""
SELECT {GROUP}, {SIDES}, any_value(threshold) AS threshold
FROM judged_metrics JOIN (SELECT {GROUP}, arg_min(threshold, date) AS threshold FROM judged GROUP BY {GROUP})
USING ({GROUP}) GROUP BY {GROUP}"""

CTE["test_scores"] = """
SELECT ticker, date, score FROM scores, splits_5 WHERE date BETWEEN test_start AND test_end"""
_F5 = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"
CTE["extremes"] = f"""
SELECT ticker, date, close, CASE WHEN count(close) {_F5} = 5 THEN max(close) {_F5} END AS max_close,
       CASE WHEN count(close) {_F5} = 5 THEN min(close) {_F5} END AS min_close FROM bars"""
CTE["simulation"] = """
SELECT *, 100 * (max_close - close) / close AS profit, 100 * (min_close - close) / close AS loss
FROM test_scores JOIN extremes USING (ticker, date)"""
BIN = """CASE WHEN score <= 0.2 THEN 0 WHEN score <= 0.4 THEN 1 WHEN score <= 0.6 THEN 2
 WHEN score <= 0.8 THEN 3 WHEN score <= 1 THEN 4 ELSE 5 END"""
CTE["targets"] = f"""
SELECT {BIN} AS bin, quantile_cont(loss, 0.25) AS buy_pct, quantile_cont(profit, 0.5) AS sell_pct
FROM simulation WHERE profit IS NOT NULL GROUP BY 1"""

W_TICKER = "PARTITION BY ticker ORDER BY date"

_NAME = re.compile(r"[a-z_]+[a-z0-9_]*")


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the table expressions it uses, in order of need."""
    known = {**CTE, **(extra or {})}
    done: dict[str, str] = {}

    def need(text):
        for name in _NAME.findall(text):
            if name in known and name not in done and name not in busy:
                busy.add(name)
                need(known[name])
                done[name] = known[name]

    busy: set[str] = set()
    need(body)
    if not done:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({sql})" for n, sql in done.items()) + "\n" + body


def rounded(body: str, columns: str | list[str], digits: int = 6) -> str:
    """Round the named columns half up on their decimal digits."""
    names = columns.split() if isinstance(columns, str) else columns
    replaced = ", ".join(
        f'CAST(round(CAST("{c}" AS DECIMAL(38, {digits + 4})), {digits}) AS DOUBLE) AS "{c}"' for c in names)
    return f"SELECT * REPLACE ({replaced}) FROM ({body})"
