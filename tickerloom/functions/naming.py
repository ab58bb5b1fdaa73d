"""Column and label names."""

from __future__ import annotations

import re

from tickerloom.constants import FEATURES, LABELS


def snake(name: str) -> str:
    """``Bear Power 80% Negatives`` -> ``bear_power_80_pct_negatives``."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower().replace("%", " pct")).strip("_")


FEATURE_COLUMNS = {snake(name): name for name in FEATURES}


def camel_label(label_type: str) -> str:
    """``median_gain`` -> ``medianGain``, the form used in folder names."""
    head, *rest = label_type.split("_")
    return head + "".join(word.capitalize() for word in rest)


def label_config(label_type: str, window: int) -> dict[str, str]:
    """Target and threshold column names and the two class names of a label."""
    if label_type not in LABELS:
        raise ValueError(f"unknown label type {label_type!r}, expected one of {sorted(LABELS)}")
    spec = LABELS[label_type]
    target = f"{spec['title']} {window}dd"
    return {
        "target": target,
        "threshold": f"Threshold {target}",
        "positive": spec["positive"],
        "negative": spec["negative"],
    }


def forecast_column(label_type: str, window: int, version: int | None = None) -> str:
    name = f"Forecast {label_config(label_type, window)['positive']} {window}dd"
    return name if version is None else f"{name} - V{version}"


def combined_columns(label_types, windows, versions=(1, 2, 3)) -> dict[str, object]:
    """Feature, target and threshold columns of the stacked forecasts, in file order."""
    longest = label_config("median_gain", max(windows))
    return {
        "feature_columns": [
            forecast_column(label, window, version)
            for version in versions for label in label_types for window in windows
        ],
        "target_column": longest["target"],
        "threshold_column": longest["threshold"],
    }
