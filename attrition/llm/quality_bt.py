"""Quality scores learned from preference pairs (Bradley-Terry).

Every document gets a feature vector from its whole text (shares of character
classes, repetition, word shape). A bounded sample of labelled rows is turned
into preference pairs, a good document preferred over a bad one; the model
P(i over j) = sigmoid(w . (f_i - f_j)) is fitted by Newton steps on the
logistic loss of the feature differences (ridge penalty). The threshold is a
quantile of the training scores: the share of rejected rows among the labels.
The result's score is sigmoid(w . f - threshold), so 0.5 is the cut.

Only the bounded sample (``SAMPLE_ROWS`` rows of some 20 numbers) reaches the
driver; scoring is one pass over the documents with no shuffle.

Defined cases: a null text is empty; an empty text has all-zero features and
is scored like any other; labels that are null or contradict each other for
one doc_id take no part; without both classes all scores are 0.5; rows that
repeat a doc_id are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import prepare

#: Bound on the labelled rows (by hash order of doc_id) that the model is fitted on.
SAMPLE_ROWS = 20_000
#: Partners drawn for each row of the larger class.
PARTNERS = 8
RIDGE = 1e-3
#: Bytes added below each share (an eighth as many words), so that a few characters of a short text weigh little.
SMOOTH = 30

UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
DIGITS = bytes(range(48, 58))
CONTINUED = bytes(range(128, 192))   # bytes of UTF-8 sequences after their first
SPACES = b" \t\n\x0b\x0c\r"
STOPS = b".,;:"
FEATURES = ("size", "upper", "digit", "space", "stop", "mark", "bang", "bar", "symbol", "line", "high",
            "word", "long", "repeated", "again", "tail", "upper_log", "mark_log", "bar_log", "again_log")


def text_features(data: bytes | None) -> list[float]:
    """The feature vector of one whole text in UTF-8; shares are of its bytes or words."""
    if not data:
        return [0.0] * len(FEATURES)
    n = len(data)

    def share(chars: bytes) -> float:
        return (n - len(data.translate(None, chars))) / (n + SMOOTH)

    words = data.split()
    w = max(1, len(words))
    upper, bar = share(UPPER), data.count(b"|") / (n + SMOOTH)
    mark = len(data.translate(None, LETTERS + DIGITS + SPACES + STOPS)) / (n + SMOOTH)
    again = sum(map(eq, words, words[1:])) / (w + SMOOTH / 8)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total = int(sizes.sum())
    stripped_ends = sum(map(len, (x.rstrip(b"*#$%&!|~^") for x in words)))
    return [
        np.log1p(n), upper, share(DIGITS), share(SPACES), share(STOPS), mark, data.count(b"!") / (n + SMOOTH), bar,
        share(b"*#$%&@~^=+<>{}[]\\_`"), data.count(b"\n") / (n + SMOOTH), share(CONTINUED),
        float(sizes.mean()) / 10 if len(words) else 0.0, float((sizes > 20).mean()) if len(words) else 0.0,
        (w - len(set(words))) / (w + SMOOTH / 8), again, (total - stripped_ends) / (total + SMOOTH),
        np.log1p(20 * upper), np.log1p(20 * mark), np.log1p(20 * bar), np.log1p(20 * again)]


def preference_pairs(good: np.ndarray, bad: np.ndarray, partners: int = PARTNERS, seed: int = 11) -> np.ndarray:
    """Feature differences of (good, bad) pairs; every row of both classes takes part."""
    if not len(good) or not len(bad):
        return np.zeros((0, good.shape[1] if good.ndim == 2 else len(FEATURES)))
    rng = np.random.default_rng(seed)
    n = max(len(good), len(bad)) * partners
    g = np.concatenate([rng.permutation(len(good)) for _ in range(-(-n // len(good)))])[:n]
    b = np.concatenate([rng.permutation(len(bad)) for _ in range(-(-n // len(bad)))])[:n]
    return good[g] - bad[b]


def fit_bradley_terry(diff: np.ndarray, ridge: float = RIDGE, rounds: int = 40) -> np.ndarray:
    """w that minimises mean log(1 + exp(-w . d)) + ridge/2 |w|^2 (damped Newton steps)."""
    w = np.zeros(diff.shape[1])
    if not len(diff):
        return w

    def loss(v: np.ndarray) -> float:
        return float(np.logaddexp(0, -diff @ v).mean() + ridge / 2 * v @ v)

    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -500, 500)))   # probability of the wrong order
        grad = ridge * w - (p[:, None] * diff).mean(0)
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w))
        step, size = np.linalg.solve(hess, grad), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        new = loss(w)
        if now - new < 1e-9:
            break
        now = new
    return w


class QualityModel:
    """Linear Bradley-Terry scores: standardised features, weights and the quantile threshold."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, w: np.ndarray, cut: float):
        self.centre, self.scale, self.w, self.cut = centre, scale, w, cut

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> "QualityModel":
        k = len(FEATURES)
        if not len(x) or y.min() == y.max():
            return cls(np.zeros(k), np.ones(k), np.zeros(k), 0.0)
        centre, scale = x.mean(0), x.std(0)
        scale[scale < 1e-9] = 1.0
        z = (x - centre) / scale
        w = fit_bradley_terry(preference_pairs(z[y == 1], z[y == 0]))
        s = z @ w
        return cls(centre, scale, w, float(np.quantile(s, (y == 0).mean(), method="midpoint")))

    def score(self, x: np.ndarray) -> np.ndarray:
        s = (x - self.centre) / self.scale @ self.w - self.cut
        return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on the labelled rows of the training folds (doc_id, text; doc_id, quality)."""
    prepare(docs.sparkSession)
    clean = (labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
             .filter("quality = other").select(F.col("doc_id").alias("_label_id"), "quality"))
    bounded = clean.orderBy(F.xxhash64("_label_id"), "_label_id").limit(sample_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(bounded), F.col("doc_id") == F.col("_label_id"))

    @F.pandas_udf("array<double>")
    def features(text: pd.Series) -> pd.Series:
        return pd.Series([text_features(t) for t in text])

    rows = texts.select("doc_id", F.col("quality").cast("int").alias("quality"),
                        features(F.col("text").cast("binary")).alias("f"))
    pdf = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).toPandas().sort_values(["doc_id"], kind="stable")
    x = np.array(pdf["f"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return QualityModel.fit(x, pdf["quality"].to_numpy(dtype=int))


def quality_score(text: Column, model: QualityModel) -> Column:
    """The score of a text column, from the whole text only."""

    @F.pandas_udf("double")
    def score(data: pd.Series) -> pd.Series:
        x = np.array([text_features(t) for t in data], dtype=float).reshape(-1, len(FEATURES))
        return pd.Series(model.score(x))

    return score(text.cast("binary"))


def op1_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train_quality(docs, labels)
    scored = docs.select("doc_id", quality_score(F.col("text"), model).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
