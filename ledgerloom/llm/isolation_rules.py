"""Quality verdicts from rule statistics and an isolation forest (operator 10).

Each text gets counts (words, symbols, repeated lines and words and so on).  A fixed base rule fails
very short and very repetitive texts.  An isolation forest over ratios of the counts judges the rest:
random splits isolate an odd document after few steps.  The forest learns from a bounded sample of the
labelled rows, and the score from which a document goes is calibrated on all of them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import append, quoted
from ledgerloom.storage import stored

TREES = 100
ROWS_PER_TREE = 256
MAX_LEARNING_ROWS = 20_000  # labelled rows that the forest learns from, about, chosen by a hash of the id
MAX_GOOD_LOST = 0.005  # share of good rows that the threshold may drop at most
_SPACES = b" \t\n\r\x0b\f"
_SYMBOLS = b"#*$%&|<>"
_STEPS = 1000  # score steps of the calibration

COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
MORE = "n_upper long, n_marks long"


def repeat_words(words: list, width: int = 3) -> int:
    """Words that lie in a run of ``width`` words found twice or more."""
    runs = list(zip(*(words[i:] for i in range(width))))
    times = Counter(runs)
    if len(times) == len(runs):
        return 0
    covered, last = 0, 0  # last: end of what is counted already
    for at, run in enumerate(runs):
        if times[run] > 1:
            covered += at + width - max(at, last)
            last = at + width
    return covered


def _count(text: str | None) -> tuple[int, ...]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    text = text or ""
    lines = [line for line in raw.split(b"\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text) - (len(raw) - len(raw.translate(None, _SPACES))),
        len(raw) - len(raw.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(raw) - len(raw.translate(None, bytes(range(65, 91)))),
        len(raw) - len(raw.translate(None, b"!?")),
    )


def _counter() -> Callable[[list], list]:
    return lambda texts: list(zip(*map(_count, texts)))


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text; null text has none of anything."""
    return append(docs, text_col, f"{COUNTS}, {MORE}", _counter)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> list[Column]:
    """How far each rule's statistic lies beyond what plain prose has; 0 for prose and for texts without words."""
    words, chars = (F.greatest(F.col(c), F.lit(1)).cast("double") for c in ("n_words", "word_chars"))
    zero = F.lit(0.0)
    return [
        F.col("n_symbols") / chars,
        F.log1p(100 * F.col("n_symbols") / words),
        F.log1p(100 * F.col("n_marks") / words),
        F.greatest(F.col("n_upper") / chars - 0.1, zero),
        F.greatest(F.col("n_repeat_words") / words - 0.3, zero),
    ]


class IsolationForest:
    """Trees of random splits; ``score`` nears 1 for rows that few splits isolate, and is about 0.5 for common ones."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = ROWS_PER_TREE, seed: int = 7):
        random = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        depth = int(np.ceil(np.log2(max(self.size, 2))))
        self.trees = [self._grow(rows[random.choice(len(rows), self.size, replace=False)], depth, random) for _ in range(trees)] if len(rows) else []

    @staticmethod
    def _left_over(n: int) -> float:
        """Mean path length of an unsuccessful search among ``n`` rows."""
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def _grow(self, rows: np.ndarray, depth: int, random: np.random.Generator) -> tuple[np.ndarray, ...]:
        feature, cut, left, right, length = [], [], [], [], []

        def node(part: np.ndarray, at: int) -> int:
            me = len(feature)
            for column, value in ((feature, -1), (cut, 0.0), (left, me), (right, me), (length, at + self._left_over(len(part)))):
                column.append(value)
            low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(rows.shape[1]),) * 2
            open_features = np.flatnonzero(high > low)
            if at < depth and len(part) > 1 and len(open_features):
                f = int(random.choice(open_features))
                c = random.uniform(low[f], high[f])
                feature[me], cut[me] = f, c
                left[me] = node(part[part[:, f] <= c], at + 1)
                right[me] = node(part[part[:, f] > c], at + 1)
            return me

        node(rows, 0)
        return tuple(np.array(c) for c in (feature, cut, left, right, length))

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.zeros(len(rows))
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, cut, left, right, length in self.trees:
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                f = feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                value = rows[every, np.maximum(f, 0)]
                at = np.where(inner, np.where(value <= cut[at], left[at], right[at]), at)
            total += length[at]
        return 2 ** (-(total / len(self.trees)) / max(self._left_over(self.size), 1e-9))


def threshold(histogram: dict[tuple[int, int], int], max_good_lost: float = MAX_GOOD_LOST) -> float:
    """Score above which rows go: most bad rows less good ones, while few good rows are lost.

    ``histogram`` counts labelled rows by (quality, score step).  Without good or bad rows nothing goes.
    """
    good, bad = (sum(n for (q, _), n in histogram.items() if q == kind) for kind in (1, 0))
    best, at = 0.0, 2.0
    lost_good = lost_bad = 0
    if good and bad:
        for step in range(_STEPS, -1, -1):
            lost_good += histogram.get((1, step), 0)
            lost_bad += histogram.get((0, step), 0)
            if lost_good > max_good_lost * good:
                break
            gain = lost_bad / bad - lost_good / good
            if gain > best:
                best, at = gain, step / _STEPS
    return at


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, kept) for every row.

    Rows without a usable label (no label, null quality or id) count in nothing but their own verdict.
    Without labelled rows of both kinds the base rule alone decides.  A doc_id with several labels is good
    only if all say so.  The counts are stored once; the forest is learned from about
    ``MAX_LEARNING_ROWS`` labelled rows, the threshold from a score histogram of all labelled rows.
    """
    rows = counts(docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text")), "text").drop("text")
    rows = stored(rows.select("*", F.array(*features()).alias("features"), base_failed().alias("base_failed")), "rule-counts")
    named = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    named = named.groupBy(F.col("doc_id").alias("label_id")).agg(F.min("quality").alias("quality"))
    labelled = stored(rows.where(~F.col("base_failed")).join(named, F.col("doc_id") == F.col("label_id")).select("doc_id", "features", "quality"), "labelled")
    sample, n = labelled, labelled.count()
    if n > MAX_LEARNING_ROWS:
        sample = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * MAX_LEARNING_ROWS / n))
    learned = sorted((r["doc_id"], *r["features"]) for r in sample.select("doc_id", "features").collect())
    forest = IsolationForest(np.array([r[1:] for r in learned], dtype=np.float64).reshape(len(learned), len(features())))
    scored = labelled.groupBy("quality", F.round(_score(forest)(F.col("features")) * _STEPS).cast("int").alias("step")).count()
    limit = threshold({(r["quality"], r["step"]): r["count"] for r in scored.collect()})
    step = F.round(_score(forest)(F.col("features")) * _STEPS) / _STEPS
    kept = ~F.col("base_failed") & (step < limit)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def _score(forest: IsolationForest):
    @F.pandas_udf("double")
    def score(features: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.stack(features.to_numpy())) if len(features) else [], dtype="float64")

    return score
