"""SQL counterparts of training that sums or a few Newton steps can express."""

from __future__ import annotations

from oracle.ctes import rounded, statement
from oracle.indicators import FEATURED
from tickerloom.functions.naming import FEATURE_COLUMNS

_F5 = "OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"
_NAMES = sorted(FEATURE_COLUMNS.values())

#: Labelled rows of the feature table with their fold; labels, thresholds and splits come from its own rows.
TRAINING = {
    **FEATURED,
    "feature_moves": f"""SELECT *, 100 * (ahead - close) / close AS move FROM (
 SELECT *, CASE WHEN count(close) {_F5} = 5 THEN quantile_cont(close, 0.4) {_F5} END AS ahead,
  row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS age FROM featured)""",
    "feature_limits": """SELECT ticker, quantile_cont(move, 0.9) FILTER (age BETWEEN 6 AND 85) AS threshold
 FROM feature_moves GROUP BY ticker""",
    "feature_dates": """SELECT date, row_number() OVER (ORDER BY date DESC) AS n
 FROM (SELECT DISTINCT date FROM feature_moves WHERE move IS NOT NULL)""",
    "feature_splits": """SELECT min(date) FILTER (n > 120) AS train_start, max(date) FILTER (n BETWEEN 81 AND 120) AS val_end,
 min(date) FILTER (n BETWEEN 81 AND 120) AS val_start, min(date) FILTER (n <= 80) AS test_start,
 max(date) FILTER (n <= 80) AS test_end FROM feature_dates""",
    "training": """SELECT * FROM (
 SELECT feature_moves.*, CASE WHEN move >= threshold THEN 1 ELSE 0 END AS label,
  CASE WHEN date BETWEEN test_start AND test_end THEN 'test' WHEN date BETWEEN val_start AND val_end THEN 'val'
   WHEN date BETWEEN train_start AND val_end THEN 'train' END AS fold
 FROM feature_moves JOIN feature_limits USING (ticker), feature_splits WHERE move IS NOT NULL) WHERE fold IS NOT NULL""",
}
_LONG = ("SELECT ticker, date, label, fold, unnest([" + ", ".join(f"'{n}'" for n in _NAMES) + "]) AS feature, unnest(["
         + ", ".join(f'CAST("{n}" AS DOUBLE)' for n in _NAMES) + "]) AS x FROM training")
BAYES = {
    **TRAINING,
    "training_long": _LONG,
    "trainable": """SELECT ticker FROM training GROUP BY ticker HAVING count(*) FILTER (fold = 'train' AND label = 0) > 0
 AND count(*) FILTER (fold = 'train' AND label = 1) > 0 AND count(*) FILTER (fold = 'val') > 0""",
    "class_moments": "SELECT ticker, feature, " + ", ".join(
        f"count(*) FILTER (label = {c}) AS n{c}, avg(x) FILTER (label = {c}) AS m{c}, coalesce(var_samp(x) FILTER (label = {c}), 0e0) AS s{c}"
        for c in (0, 1)) + " FROM training_long JOIN trainable USING (ticker) WHERE fold <> 'test' GROUP BY ticker, feature",
    "smooth_moments": "SELECT *, s0 + more AS v0, s1 + more AS v1 FROM (SELECT *, 0.1e0 * (s0 * n0 + s1 * n1) / (n0 + n1) + 1e-4 AS more FROM class_moments)",
    "weights": """SELECT ticker, feature, m1 / v1 - m0 / v0 AS linear, 0.5e0 / v0 - 0.5e0 / v1 AS square FROM smooth_moments""",
    "intercepts": """SELECT ticker, ln(any_value(n1) / any_value(n0)) + sum(m0 * m0 / (2 * v0) + ln(v0) / 2)
 - sum(m1 * m1 / (2 * v1) + ln(v1) / 2) AS intercept FROM smooth_moments GROUP BY ticker""",
    "bayes": """SELECT ticker, date, any_value(label) AS label, any_value(fold) AS fold,
 1 / (1 + exp(-greatest(-30, least(30, any_value(intercept) + sum(linear * x + square * x * x))))) AS p
 FROM training_long JOIN weights USING (ticker, feature) JOIN intercepts USING (ticker) GROUP BY ticker, date""",
    "bayes_ranked": """SELECT *, rank() OVER (PARTITION BY ticker ORDER BY p)
 + (count(*) OVER (PARTITION BY ticker, p) - 1) / 2e0 AS r FROM bayes WHERE fold = 'test'""",
    "bayes_gini": """SELECT ticker, coalesce(2 * (sum(r) FILTER (label = 1) - n1 * (n1 + 1) / 2e0) / nullif(n1 * n0, 0) - 1, 0e0) AS gini
 FROM (SELECT *, count(*) FILTER (label = 1) OVER (PARTITION BY ticker) AS n1, count(*) FILTER (label = 0) OVER (PARTITION BY ticker) AS n0
  FROM bayes_ranked) GROUP BY ticker, n1, n0""",
}

SQL = {
    "train_per_ticker": statement(rounded(
        "SELECT ticker, intercept, feature, linear, square FROM weights JOIN intercepts USING (ticker)", "intercept linear square", 3), BAYES),
    "forecast": statement(rounded(
        "SELECT ticker, date, p FROM bayes WHERE ticker IN (SELECT ticker FROM bayes_gini WHERE gini >= 0)", "p", 3), BAYES),
    "model_store": statement(rounded(
        "SELECT ticker, avg(p) AS ticker_p, 0e0 AS ticker_difference, 0e0 AS market_difference FROM bayes GROUP BY ticker",
        "ticker_p ticker_difference market_difference", 3), BAYES),
}


def newton(source: str, steps: int = 14) -> dict[str, str]:
    """Penalised logistic regression of y on p and gini: ``fitted`` has one row (b, w, g)."""
    sums = {
        "g0": "sum(e)", "g1": "sum(e * p) + w", "g2": "sum(e * gini) + g", "a": "sum(q)", "c": "sum(q * p)", "d": "sum(q * gini)",
        "f": "sum(q * p * p) + 1", "h": "sum(q * p * gini)", "k": "sum(q * gini * gini) + 1",
    }
    return {
        "newton": f"""SELECT 0 AS i, 0e0 AS b, 0e0 AS w, 0e0 AS g
UNION ALL
SELECT i + 1, b - (g0 * (f * k - h * h) - c * (g1 * k - h * g2) + d * (g1 * h - f * g2)) / det,
 w - (a * (g1 * k - h * g2) - g0 * (c * k - h * d) + d * (c * g2 - g1 * d)) / det,
 g - (a * (f * g2 - g1 * h) - c * (c * g2 - g1 * d) + g0 * (c * h - f * d)) / det
FROM (SELECT *, a * (f * k - h * h) - c * (c * k - h * d) + d * (c * h - f * d) AS det FROM (
 SELECT i, b, w, g, {', '.join(f'{v} AS {n}' for n, v in sums.items())} FROM (
  SELECT *, s - y AS e, s * (1 - s) AS q FROM (
   SELECT i, b, w, g, t.p, t.gini, t.y, 1 / (1 + exp(-(b + w * t.p + g * t.gini))) AS s FROM newton, {source} t))
 WHERE i < {steps} GROUP BY i, b, w, g))""",
        "fitted": f"SELECT b, w, g FROM newton WHERE i = {steps}",
    }
