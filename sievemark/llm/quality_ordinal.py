"""Quality by ordinal cumulative-link regression on graded ratings.

A text is a bag of hashed words, word shapes and immediate repetitions, averaged over its words. All
thresholds between neighbouring grades share these weights: P(grade > k) = sigmoid(w.x - c_k), with
c_0 < c_1 < ... . The model gives the expected grade and the probability of a grade above a cut, by which
documents are selected. Two grades are the smallest case.

A text that is null or has no word gets the lowest grade, tail probability 0 and is rejected. Rows are
independent. With no ratings, or one grade only, every text that has words gets that grade and is accepted.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import append_columns, flat_rows, hashed_sample

BUCKETS = 1 << 14
SAMPLE_TEXTS = 3000  # rated texts per grade that the model is fitted on
MAX_WORDS = 150_000  # words whose weight a task remembers


def word_features(word: str) -> tuple[int, int]:
    """Buckets of the word and of its shape."""
    letters = [c for c in word if c.isalpha()]
    case = "U" if len(letters) > 1 and word.upper() == word else "T" if letters and letters[0].isupper() else "l" if letters else "-"
    marks = "".join(sorted({c for c in word if not c.isalnum()}))[:6]
    shape = f"{case}|{marks}|{'0' if any(c.isdigit() for c in word) else ''}|{min(len(word) // 8, 4)}"
    # Half of the buckets belong to words, half to shapes.
    half = BUCKETS // 2
    return xxhash.xxh3_64_intdigest(word.lower().encode()) % (half - 1), half + xxhash.xxh3_64_intdigest(shape.encode()) % half


REPEAT = BUCKETS // 2 - 1  # bucket of a word that equals the one before it


def text_features(text: str | None) -> tuple[list[int], list[float]]:
    """Sparse averaged features of a whole text."""
    words = text.split() if text else []
    if not words:
        return [], []
    total: dict[int, float] = {REPEAT: float(sum(map(eq, words, words[1:])))}
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    for w, n in counts.items():
        for i in word_features(w):
            total[i] = total.get(i, 0.0) + n
    return list(total), [v / len(words) for v in total.values()]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    cuts: np.ndarray  # ascending, one fewer than grades
    grades: list[float]  # ascending

    def tails(self, score: float) -> np.ndarray:
        """P(grade > k) for every cut."""
        return 1 / (1 + np.exp(-np.clip(score - self.cuts, -35, 35)))

    def expected(self, tails: np.ndarray) -> float:
        return float(self.grades[0] + np.diff(self.grades) @ tails) if len(self.grades) > 1 else float(self.grades[0])


def _fit(rows: list[tuple[int, list[int], list[float]]], grades: list[float], weight: np.ndarray, steps: int = 400, rate: float = 0.3, decay: float = 2e-5) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam; cuts are kept in order as a first cut and positive gaps."""
    y = np.array([r[0] for r in rows])
    at = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    cols = np.concatenate([np.asarray(r[1], int) for r in rows])
    vals = np.concatenate([np.asarray(r[2], float) for r in rows])
    k = len(grades) - 1
    theta = np.zeros(BUCKETS + k)
    theta[BUCKETS + 1 :] = 0.5
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, gaps = theta[:BUCKETS], np.exp(theta[BUCKETS + 1 :])
        cuts = theta[BUCKETS] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(at, vals * w[cols], len(rows))
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - cuts, -35, 35)))
        edge = np.hstack([np.ones((len(rows), 1)), p, np.zeros((len(rows), 1))])
        prob = np.maximum(edge[np.arange(len(rows)), y] - edge[np.arange(len(rows)), y + 1], 1e-12)
        slope = np.hstack([np.zeros((len(rows), 1)), p * (1 - p), np.zeros((len(rows), 1))])
        low, high = slope[np.arange(len(rows)), y], slope[np.arange(len(rows)), y + 1]
        g_score = weight * (low - high) / prob  # gradient of the log-likelihood by the score
        g_cut = np.zeros(k)
        for j in range(k):
            g_cut[j] = (weight * (np.where(y == j, high, 0) - np.where(y == j + 1, low, 0)) / prob).sum()
        grad = np.zeros_like(theta)
        grad[:BUCKETS] = np.bincount(cols, vals * g_score[at], BUCKETS) / len(rows) - decay * w
        grad[BUCKETS] = g_cut.sum() / len(rows)
        for j in range(1, k):
            grad[BUCKETS + j] = g_cut[j:].sum() * gaps[j - 1] / len(rows)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
    gaps = np.exp(theta[BUCKETS + 1 :])
    return OrdinalModel(theta[:BUCKETS].astype("float32"), theta[BUCKETS] + np.concatenate([[0.0], np.cumsum(gaps)]), grades)


def fit_quality(rated: DataFrame, text: str = "text", grade: str = "grade", per_grade: int = SAMPLE_TEXTS, prior: dict | None = None) -> OrdinalModel:
    """Fits on at most about ``per_grade`` distinct texts of each grade; grades may be any ordered numbers.

    Rows without a grade or text are left out of the fit. ``prior`` has the rows of each grade, counted here
    if not given; grades weigh by its square root, between an even weight and their true shares.
    """
    rated = rated.filter(F.col(text).isNotNull() & F.col(grade).isNotNull()).select(F.col(grade).cast("double").alias("_grade"), F.col(text).alias("_text"))
    sample = hashed_sample(rated, "_grade", "_text", per_grade)

    def make():
        def run(grades, texts):
            for g, t in zip(grades, texts):
                cols, vals = text_features(t)
                if cols:
                    yield g, cols, vals

        return run

    rows = flat_rows(sample, ["_grade", "_text"], "g double, cols array<int>, vals array<double>", make).collect()
    grades = sorted({r[0] for r in rows})
    if len(grades) < 2:
        return OrdinalModel(np.zeros(BUCKETS, "float32"), np.zeros(0), grades or [0.0])
    share = prior or {r[0]: r[1] for r in rated.groupBy("_grade").count().collect()}
    in_sample = {g: sum(r[0] == g for r in rows) for g in grades}
    weight = np.array([(share.get(r[0], 1) / in_sample[r[0]]) ** 0.5 for r in rows])
    return _fit([(grades.index(r[0]), r[1], r[2]) for r in rows], grades, weight / weight.mean())


def score_quality(df: DataFrame, model: OrdinalModel, text: str = "text", above: float | None = None, least: float = 0.5) -> DataFrame:
    """The rows with expected_grade, tail_probability of a grade above ``above`` and accepted.

    ``above`` is the lowest grade unless given; a text is accepted if that probability is at least ``least``.
    """
    cut = next((i for i, g in enumerate(model.grades) if g >= (model.grades[0] if above is None else above)), 0)
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def make():
        m = shared.value
        known: dict[str, float] = {}
        repeat = float(m.weights[REPEAT])

        def weight(word: str) -> float:
            if len(known) >= MAX_WORDS:
                known.clear()
            a, b = word_features(word)
            known[word] = w = float(m.weights[a]) + float(m.weights[b])
            return w

        def score(text: str) -> tuple[float, float, bool]:
            words = text.split() if text else []
            if not words:
                return float(m.grades[0]), 0.0, False
            if not len(m.cuts):
                return float(m.grades[0]), 1.0, True
            found = [known.get(w) for w in words]
            if None in found:
                found = [weight(w) if f is None else f for w, f in zip(words, found)]
            tails = m.tails((sum(found) + repeat * sum(map(eq, words, words[1:]))) / len(words))
            tail = float(tails[min(cut, len(tails) - 1)])
            return m.expected(tails), tail, tail >= least

        def run(texts):
            out = [score(t) for t in texts]
            return [list(c) for c in zip(*out)] if out else [[], [], []]

        return run

    return append_columns(df, [text], "expected_grade double, tail_probability double, accepted boolean", make)
