"""Quality of texts by a regularised quadratic discriminant.

A text becomes a vector of transformed statistics. Each class is a Gaussian
over these; its covariance is shrunk towards the pooled covariance and towards
a multiple of the identity. The log-density of a class is its Mahalanobis
distance, by a Cholesky factor computed once, and its log-determinant. The
difference of the two log-densities, put on a probability scale by a logistic
fit, is the score.

The fit reads every labelled row outside the held-out part: the sums of the
vectors and of their products are Spark aggregates, and only sums come to the
driver (some hundred numbers, whatever the input).

Defined results: a null or empty text has all its statistics at zero and is
scored like any other; labels other than 0 and 1 are left out, a label given
twice counts twice; if a class has fewer than two rows, every score is 0.5. The
score is a function of the text alone: equal texts, and so repeated rows, have equal
scores. Texts of any length are read whole; an empty table gives an empty result;
other columns, whatever their names, are not looked at and pass ``drop_low_quality``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.llm.shared import crc_mod, keep, resident, ship, text_of

FEATURES = (
    "log_chars", "log_words", "log_lines", "word_length", "word_length_spread", "letters",
    "upper", "digits", "symbols", "odd_words", "stops", "distinct", "top_word", "echoes",
    "repeated_lines", "top_symbol", "line_length",
)
# Weights of the two shrinkage targets: the pooled covariance, then the identity.
POOL = 0.2
RIDGE = 0.02
THRESHOLD = 0.3

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LEAD = np.zeros(256, bool)
_LEAD[192:256] = True  # first bytes of characters beyond ASCII, nearly all letters here
_SYMBOL = np.zeros(256, bool)
_SYMBOL[33:127] = True
_SYMBOL &= ~(_UPPER | _LOWER | _DIGIT)
for _c in b".,'\";:()-":
    _SYMBOL[_c] = False


def _angle(share: float) -> float:
    """Spreads shares near 0 and 1."""
    return math.asin(math.sqrt(min(1.0, max(0.0, share))))


def statistics(text: str) -> list[float]:
    """The transformed statistics of a text, in the order of ``FEATURES``."""
    if not text or text.isspace():
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    n_words, n_chars = len(words), len(text)
    lengths = np.fromiter(map(len, words), np.int64, n_words)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    upper, lower, lead = int(count[_UPPER].sum()), int(count[_LOWER].sum()), int(count[_LEAD].sum())
    symbols = int(count[_SYMBOL].sum())
    shown = max(1, n_chars - int(count[32] + count[10] + count[13] + count[9]))
    odd = sum(1 for w in seen if not w[-1].isalnum() and w[-1] not in ".,;:)\"'")
    odd_words = sum(seen[w] for w in seen if not w[-1].isalnum() and w[-1] not in ".,;:)\"'") if odd else 0
    echoes = sum(map(str.__eq__, words, words[1:]))
    return [
        math.log1p(n_chars),
        math.log1p(n_words),
        math.log1p(len(lines)),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        _angle((upper + lower + lead) / shown),
        _angle(upper / max(1, upper + lower)),
        _angle(int(count[_DIGIT].sum()) / shown),
        _angle(symbols / shown),
        _angle(odd_words / n_words),
        _angle(int(count[46]) / n_words),
        math.log1p(len(seen)) / math.log1p(n_words),
        _angle(max(seen.values()) / n_words),
        _angle(echoes / n_words),
        _angle(1 - len(set(lines)) / len(lines)),
        _angle(int(count[_SYMBOL].max()) / shown),
        math.log1p(n_chars / len(lines)),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    resident("statistics")
    for batch in texts:
        yield pd.Series([statistics(t) for t in batch], dtype=object)


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """For each class: rows, sums and sums of products of (label, x)."""
    d = len(FEATURES)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=np.float64).reshape(len(batch), d)
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            y = batch["label"].to_numpy()
            for c in (0, 1):
                part = x[y == c]
                if len(part):
                    held[c] = held.get(c, 0) + part.T @ part
        for c, products in held.items():
            yield pd.DataFrame(
                {"label": c, "cell": np.arange(products.size), "value": products.ravel()}
            )

    sums = (
        rows.mapInPandas(partial, "label int, cell int, value double")
        .groupBy("label", "cell")
        .agg(F.sum("value").alias("value"))
        .collect()  # two classes by (1 + features) squared numbers
    )
    found = {}
    for c in (0, 1):
        cells = {r.cell: r.value for r in sums if r.label == c}
        if cells:
            m = np.array([cells[i] for i in range((d + 1) ** 2)]).reshape(d + 1, d + 1)
            found[c] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return found


class Discriminant:
    """Two shrunk Gaussians with their Cholesky factors, and the logistic scale."""

    def __init__(self, moments: dict, pool: float = POOL, ridge: float = RIDGE):
        self.usable = all(moments.get(c, (0,))[0] >= 2 for c in (0, 1))
        self.scale = (1.0, 0.0)
        if not self.usable:
            return
        total = sum(moments[c][0] for c in (0, 1))
        scatter = {}
        means = {}
        for c in (0, 1):
            n, s, p = moments[c]
            means[c] = s / n
            scatter[c] = p - np.outer(s, s) / n
        pooled = (scatter[0] + scatter[1]) / total
        self.center = (moments[0][1] + moments[1][1]) / total
        self.unit = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        self.classes = []
        for c in (0, 1):
            n = moments[c][0]
            own = (1 - pool) * scatter[c] / n + pool * pooled
            own = own / np.outer(self.unit, self.unit)
            d = len(own)
            own = (1 - ridge) * own + ridge * (np.trace(own) / d + 1e-6) * np.eye(d)
            factor = np.linalg.cholesky(own)
            self.classes.append(
                (
                    (means[c] - self.center) / self.unit,
                    np.linalg.inv(factor),
                    -np.log(np.diag(factor)).sum() + math.log(n / total),
                )
            )

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, over the square root of the dimension."""
        z = (x - self.center) / self.unit
        log = []
        for mean, inverse, constant in self.classes:
            log.append(constant - 0.5 * (((z - mean) @ inverse.T) ** 2).sum(axis=1))
        return (log[1] - log[0]) / math.sqrt(x.shape[1])

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.full(len(x), 0.5)
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.margin(x) + b, -35, 35)))


def _logistic(bins: np.ndarray, ones: np.ndarray, all_: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through counts by margin, slightly smoothed."""
    n1, n = ones.sum(), all_.sum()
    high, low = (n1 + 1) / (n1 + 2), 1 / (n - n1 + 2)
    target = (ones * high + (all_ - ones) * low) / all_
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * bins + b, -35, 35)))
        g = np.array([((p - target) * all_ * bins).sum() + 1e-3 * a, ((p - target) * all_).sum()])
        w = all_ * np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * bins * bins).sum() + 1e-3, (w * bins).sum()], [(w * bins).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return (a, b) if a > 0 and math.isfinite(a + b) else (1.0, 0.0)


def fit(rows: DataFrame) -> Discriminant:
    """The discriminant of rows with ``x`` (the statistics) and ``label``.

    Margins for the logistic scale are counted in steps of a tenth between -40
    and 40, so 801 counts come to the driver.
    """
    model = Discriminant(_moments(rows))
    if not model.usable:
        return model

    @F.pandas_udf("double")
    def step(xs: pd.Series) -> pd.Series:
        x = np.array(xs.tolist(), dtype=np.float64).reshape(len(xs), len(FEATURES))
        return pd.Series(np.clip(np.round(model.margin(x), 1), -40, 40))

    counted = (
        rows.select("label", step("x").alias("margin"))
        .groupBy("margin")
        .agg(F.sum("label").alias("ones"), F.count("*").alias("n"))
        .orderBy("margin")
        .collect()
    )
    model.scale = _logistic(
        np.array([r.margin for r in counted], dtype=float),
        np.array([r.ones for r in counted], dtype=float),
        np.array([r.n for r in counted], dtype=float),
    )
    return model


def score_column(model: Discriminant, x: str | Column) -> Column:
    """The score of a column of statistics."""

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        x = np.array(xs.tolist(), dtype=np.float64).reshape(len(xs), len(FEATURES))
        return pd.Series(model.score(x))

    return score(x)


def text_score(model: Discriminant, text: Column) -> Column:
    """The score of a column of texts, in one step."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        resident("statistics")
        for batch in texts:
            x = np.array([statistics(t) for t in batch], dtype=np.float64)
            yield pd.Series(model.score(x.reshape(len(batch), len(FEATURES))))

    return score(text)


def labelled(described: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The statistics of the rows to learn from: labelled, and not held out."""
    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col(id_col).alias("_id"), F.col("quality").cast("int").alias("label")
    )
    return (
        described.filter(crc_mod(id_col, 5) != 0)
        .select(F.col(id_col).alias("_id"), "x")
        .join(known, "_id")
        .select("label", "x")
    )


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: the id, held_out, score and predicted."""
    ship(docs.sparkSession)
    described = keep(
        docs.select(id_col, text_statistics(text_of(text_col)).alias("x")), "statistics"
    )
    model = fit(keep(labelled(described, labels, id_col), "labelled"))
    return described.select(
        id_col,
        (crc_mod(id_col, 5) == 0).alias("held_out"),
        score_column(model, "x").alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that the classifier does not reject.

    The fit reads the texts of labelled rows; the scores are computed in the
    scan that filters, so no text is shuffled.
    """
    ship(docs.sparkSession)
    described = docs.select(id_col, text_statistics(text_of(text_col)).alias("x"))
    model = fit(keep(labelled(described, labels, id_col), "labelled"))
    return docs.filter(text_score(model, text_of(text_col)) >= THRESHOLD)
