"""Quality rules: a learned decision list over statistics of whole texts.

Statistics (words, symbols, repeated lines and windows, letters) are counted for every text. From the statistics of
labelled rows, sequential covering learns rules: a rule grows by the threshold that separates low quality best, one
after another, on two thirds of the rows; on the other third it is pruned from its end while that makes it better; the
rows it covers are taken out and the next rule grows, until a rule is not sure enough. The list is a chain of Spark
conditions in the order of learning: the first rule that holds rejects a text, otherwise it stays.

The fit reads the statistics of about ``rows`` labelled texts outside the held-out fold, a documented bound; only
numbers, not texts, reach the driver. The list then judges every row.

Defined cases: a missing text has no words and counts as empty; ratios over nothing are 0; without labelled rows, or
with one class only, the list is empty and rejects nothing (the base conditions still do); repeated rows are judged
alike; an empty table gives an empty result; extra columns are no input.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import known_labels, text_udf, whole_text

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Words in a window that is looked for again.
RUN = 5
#: Labelled rows whose statistics the fit may read.
SAMPLE_ROWS = 20_000
#: Thresholds tried per statistic, conditions in a rule, rules in the list.
CUTS, CONDITIONS, LENGTH = 48, 4, 12
#: The share of low quality that a rule needs on either part, and how many rows it was not grown on.
SURE, SUPPORT = 0.9, 5
#: The same share with one more row of each class.
LIKELY = 0.8

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits",
    "n_marks", "n_distinct_words", "n_top_word",
)
#: Statistics that rules may use: a count, or the share of one count in another.
STATISTICS = {
    "n_words": ("n_words", None), "mean_word": ("word_chars", "n_words"), "symbols_per_word": ("n_symbols", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"), "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"), "upper_share": ("n_upper", "n_lower"), "digit_share": ("n_digits", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"), "distinct_share": ("n_distinct_words", "n_words"),
    "top_word_share": ("n_top_word", "n_words"),
}


def counts_of(text: str) -> tuple[int, ...]:
    """The ``COUNTS`` of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes part at the six ASCII blanks only
    n, repeated = len(words), 0
    if n > RUN:
        windows = list(zip(*[words[i:] for i in range(RUN)]))
        if len(set(windows)) < len(windows):
            seen = Counter(windows)
            end = 0  # words before this position are counted
            for i, window in enumerate(windows):
                if seen[window] > 1:
                    repeated += i + RUN - max(i, end)
                    end = i + RUN
    lines, earlier, dup, full = text.split("\n"), set(), 0, 0
    for line in lines:
        if line.strip(BLANKS):
            full += 1
            dup += line in earlier
            earlier.add(line)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    seen_bytes = np.bincount(data, minlength=256)
    top = Counter(words).most_common(1)
    return (
        n, len(text) - int(seen_bytes[[ord(c) for c in BLANKS]].sum()), int(seen_bytes[[ord(c) for c in SYMBOLS]].sum()),
        dup, repeated, full, int(seen_bytes[65:91].sum()), int(seen_bytes[97:123].sum()), int(seen_bytes[48:58].sum()),
        int(seen_bytes[[ord(c) for c in "!?.,;:"]].sum()), len(set(words)), top[0][1] if top else 0,
    )


def counted(text: Column) -> Column:
    """The ``COUNTS`` of a text column, as a struct."""

    @text_udf(f"struct<{','.join(f'{name}:bigint' for name in COUNTS)}>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.array([counts_of(t.as_py() or "") for t in texts], np.int64).reshape(len(texts), len(COUNTS))
            yield pa.StructArray.from_arrays([pa.array(found[:, i]) for i in range(len(COUNTS))], list(COUNTS))

    return count(text)


def statistic(counts: str, name: str) -> Column:
    """A statistic out of the struct column ``counts``; a share of nothing is 0."""
    over, under = STATISTICS[name]
    value = F.col(f"{counts}.{over}").cast("double")
    return value if under is None else F.coalesce(F.try_divide(value, F.col(f"{counts}.{under}").cast("double")), F.lit(0.0))


def base_failed(counts: str = "counts") -> Column:
    words, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (words < 10) | (100 * repeated > 20 * words)


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        return table[self.name] > self.cut if self.above else table[self.name] <= self.cut

    def column(self, counts: str) -> Column:
        value = statistic(counts, self.name)
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], rows: np.ndarray) -> np.ndarray:
    found = rows
    for condition in rule:
        found = found & condition.holds(table)
    return found


def _grown(table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """Add the condition of the largest information gain until only low quality is covered."""
    rule: Rule = ()
    inside = rows.copy()
    while len(rule) < CONDITIONS and (n := inside.sum()) and (k := (inside & bad).sum()) < n:
        before, best = np.log2(k / n) if k else -20.0, (0.0, None)
        for name, values in table.items():
            here, low = values[inside], bad[inside]
            order = np.argsort(here, kind="stable")
            here, low = here[order], np.cumsum(low[order])
            ends = np.flatnonzero(np.diff(here))  # a cut lies between two different values
            if not len(ends):
                continue
            picked = ends[np.unique(np.linspace(0, len(ends) - 1, CUTS).astype(int))]
            cuts = (here[picked] + here[picked + 1]) / 2
            for above in (False, True):
                good = (low[-1] - low[picked]) if above else low[picked]
                size = (len(here) - picked - 1) if above else picked + 1
                gain = good * (np.log2(np.maximum(good, 1e-9) / size) - before)
                at = int(np.argmax(gain))
                if gain[at] > best[0] + 1e-9:
                    best = float(gain[at]), Condition(name, above, float(cuts[at]))
        if best[1] is None:
            break
        rule += (best[1],)
        inside = _covers(rule, table, rows)
    return rule


def _pruned(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
    """The start of the rule with the best (right - wrong) / covered on rows it was not grown on."""
    best, kept = -2.0, rule
    for n in range(len(rule), 0, -1):
        inside = _covers(rule[:n], table, rows)
        size, right = inside.sum(), (inside & bad).sum()
        value = (2 * right - size) / (size + 1)
        if value >= best:
            best, kept = value, rule[:n]
    return kept


def learnt_rules(table: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Sequential covering: the decision list for low quality; ``table`` has the statistics of the labelled rows."""
    bad = np.asarray(bad, bool)
    fold = np.arange(len(bad)) % 3 == 0
    left, rules = np.ones(len(bad), bool), []
    while len(rules) < LENGTH and (left & bad & ~fold).any():
        rule = _grown(table, bad, left & ~fold)
        if not rule:
            break
        rule = _pruned(rule, table, bad, left & fold)
        tested, grown = _covers(rule, table, left & fold), _covers(rule, table, left & ~fold)
        # one more of each class is counted in, so a few lucky rows make no rule
        sure = ((tested & bad).sum() + 1) / (tested.sum() + 2) >= LIKELY and (grown & bad).sum() >= SURE * grown.sum()
        if not sure or tested.sum() < min(SUPPORT, max(1, len(bad) // 100)) or (tested & bad).sum() < SURE * tested.sum():
            break
        rules.append(rule)
        left &= ~_covers(rule, table, left)
    return rules


def learnt(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The decision list of the labelled rows of ``docs`` (doc_id, text); ``labels`` has doc_id and quality."""
    known = known_labels(docs, labels, "quality", rows, 13)
    found = (
        docs.join(F.broadcast(known), "doc_id").select("doc_id", "label", counted(whole_text()).alias("counts"))
        .select("doc_id", "label", *[statistic("counts", name).alias(name) for name in STATISTICS])
        .groupBy("doc_id", "label").agg(*[F.min(name).alias(name) for name in STATISTICS])
        .collect()
    )
    found.sort(key=lambda r: r["doc_id"])
    return learnt_rules(
        {name: np.array([r[name] for r in found], float) for name in STATISTICS}, np.array([r["label"] == 0 for r in found]),
    )


def verdict(rules: list[Rule], counts: str = "counts") -> Column:
    """Whether a text stays: the first rule that holds rejects it."""
    chain = None
    for rule in rules:
        holds = rule[0].column(counts)
        for condition in rule[1:]:
            holds = holds & condition.column(counts)
        chain = F.when(holds, F.lit(False)) if chain is None else chain.when(holds, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def judged(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """For every row of ``docs``: doc_id, counts (struct), base_failed and kept."""
    rules = learnt(docs.select("doc_id", "text"), labels, rows)
    return docs.select("doc_id", counted(whole_text()).alias("counts")).select(
        "doc_id", "counts", base_failed().alias("base_failed"), (~base_failed() & verdict(rules)).alias("kept"),
    )
