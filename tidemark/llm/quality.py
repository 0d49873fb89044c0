"""Quality scores by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; the unlabelled side are all texts, whatever
their labels. The share of positives among these, the class prior, is estimated first: a
classifier of positives against unlabelled texts is fitted, and the prior is the least ratio of
the shares of unlabelled and positive texts above a score, as only positives score high. The
scorer then minimises the non-negative unbiased risk with logistic loss

    prior * loss(positives, 1) + max(0, loss(unlabelled, 0) - prior * loss(positives, 0)),

so its sigmoid estimates the probability of quality 1. It is additive over binned statistics of
the whole text: shares of character classes, repetition of words, lengths of words and lines.

Only what gradient steps run over is bounded: the positives and the unlabelled rows that the
classifiers are fitted to, both chosen by a hash, so the same for any order and files of a table.
The prior and the cut come from histograms of the logits of all rows, and every row is scored.
Nulls: a null text is empty and scored as such; a null id belongs to no fold and is never learnt
from. Without positives every score is one half. Repeated rows are each scored; other columns
stay, whatever they are called, but for one that is called like the score, which it replaces.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import columns_of, durable, numbered, place, some_ids, text_of

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".",
    "comma": b",",
    "shout": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[\\]^_`{}~",
    "other_mark": b"\"'();:-",
    "high": bytes(range(128, 256)),
}
_MASKS = np.array([np.isin(np.arange(256), list(chars)) for chars in _CLASSES.values()]).T.astype(float)
N_FEATURES = len(_CLASSES) + 12


def features(text: str) -> np.ndarray:
    """Statistics of a whole text; shares are of its bytes or words."""
    data = text.encode()
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _MASKS / max(1, len(data))
    words = data.split()
    n = max(1, len(words))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lines = data.split(b"\n")
    rest = [
        np.log1p(len(data)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        len(counts) / n,
        len(counts) / np.sqrt(n),
        pairs / max(1, n - 1),
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
        np.log1p(max(map(len, counts), default=0)),
        sum(word.isalpha() for word in counts) / max(1, len(counts)),
    ]
    return np.concatenate([shares, rest])


@dataclass
class Model:
    """One weight per bin of each feature, and a bias."""

    edges: np.ndarray  # features x (bins - 1)
    weights: np.ndarray  # features x bins
    bias: float

    def bins(self, rows: np.ndarray) -> np.ndarray:
        found = [np.searchsorted(e, column, side="right") for e, column in zip(self.edges, rows.T, strict=True)]
        return np.stack(found, axis=1)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        return self.weights[np.arange(len(self.weights)), self.bins(rows)].sum(axis=1) + self.bias


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _edges(rows: np.ndarray, bins: int) -> np.ndarray:
    return np.quantile(rows, np.linspace(0, 1, bins + 1)[1:-1], axis=0).T


class _Fit:
    """Gradient steps (Adam) on the weights of binned rows."""

    def __init__(self, edges: np.ndarray, decay: float = 1e-3) -> None:
        features_, bins = edges.shape[0], edges.shape[1] + 1
        self.model = Model(edges, np.zeros((features_, bins)), 0.0)
        self.shape = (features_, bins)
        self.decay = decay
        self.moments = np.zeros((2, features_ * bins + 1))
        self.turn = 0

    def place(self, rows: np.ndarray) -> np.ndarray:
        return self.model.bins(rows) + np.arange(self.shape[0]) * self.shape[1]

    def logits(self, placed: np.ndarray) -> np.ndarray:
        return self.model.weights.ravel()[placed].sum(axis=1) + self.model.bias

    def gradient(self, placed: np.ndarray, slopes: np.ndarray) -> np.ndarray:
        size = self.shape[0] * self.shape[1]
        each = np.repeat(slopes, placed.shape[1])
        return np.append(np.bincount(placed.ravel(), weights=each, minlength=size), slopes.sum())

    def step(self, gradient: np.ndarray, rate: float) -> None:
        self.turn += 1
        gradient[:-1] += self.decay * self.model.weights.ravel()
        self.moments[0] += 0.1 * (gradient - self.moments[0])
        self.moments[1] += 0.001 * (gradient**2 - self.moments[1])
        first, second = self.moments[0] / (1 - 0.9**self.turn), self.moments[1] / (1 - 0.999**self.turn)
        change = rate * first / (np.sqrt(second) + 1e-9)
        self.model.weights -= change[:-1].reshape(self.shape)
        self.model.bias -= float(change[-1])


class Histogram:
    """How many rows have which logit, in steps of 1/256: exact counts of a whole table."""

    STEP = 1 / 256
    MOST = 30 * 256  # logits beyond count as the farthest

    def __init__(self, counts: dict[int, int]) -> None:
        self.places = np.array(sorted(counts), np.int64)
        self.counts = np.array([counts[at] for at in self.places.tolist()], np.int64)

    @classmethod
    def place_of(cls, logits: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(logits / cls.STEP), -cls.MOST, cls.MOST).astype(np.int64)

    @classmethod
    def of(cls, logits: np.ndarray) -> Histogram:
        return cls(Counter(cls.place_of(logits).tolist()))

    @property
    def total(self) -> int:
        return int(self.counts.sum())

    def share_from(self, logit: float) -> float:
        """The share of rows at or above a logit, to a step."""
        return float(self.counts[self.places >= self.place_of(np.array(logit))].sum() / max(1, self.total))

    def quantile(self, share: float) -> float:
        at = np.searchsorted(np.cumsum(self.counts), share * self.total)
        return float(self.places[min(at, len(self.places) - 1)] * self.STEP)


def fit_prior_scorer(positive: np.ndarray, unlabelled: np.ndarray, edges: np.ndarray, steps: int) -> Model:
    """A classifier of positives against unlabelled rows."""
    fit = _Fit(edges)
    p, u = fit.place(positive), fit.place(unlabelled)
    for _ in range(steps):
        gradient = fit.gradient(p, -(1 - sigmoid(fit.logits(p))) / (2 * len(p)))
        fit.step(gradient + fit.gradient(u, sigmoid(fit.logits(u)) / (2 * len(u))), 0.05)
    return fit.model


def estimate_prior(of_p: np.ndarray, of_u: Histogram) -> float:
    """The share of positives among unlabelled rows, from logits that no row was fitted to."""
    of_p = np.sort(of_p)
    ratios = []
    for share in np.linspace(0.3, 0.99, 70):
        least = of_p[int((1 - share) * len(of_p))]
        above_p = 1 - np.searchsorted(of_p, least) / len(of_p)
        above_u = of_u.share_from(least)
        # Two standard errors, so that a small table does not give too small a least.
        spread = 2 * np.sqrt(above_u * (1 - above_u) / max(1, of_u.total) + above_p * (1 - above_p) / len(of_p))
        ratios.append((above_u + spread) / above_p)
    return float(np.clip(min(ratios), 0.02, 0.98))


def fit_non_negative(
    positive: np.ndarray, unlabelled: np.ndarray, edges: np.ndarray, prior: float, steps: int
) -> Model:
    """The scorer of least non-negative risk."""
    fit = _Fit(edges, decay=2e-5)
    p, u = fit.place(positive), fit.place(unlabelled)
    for turn in range(steps):
        of_p, of_u = sigmoid(fit.logits(p)), sigmoid(fit.logits(u))
        as_negative = lambda scores: -np.log(np.maximum(1e-12, 1 - scores)).mean()
        negative_risk = as_negative(of_u) - prior * as_negative(of_p)
        unlabelled_part = fit.gradient(u, of_u / len(u)) - fit.gradient(p, prior * of_p / len(p))
        positive_part = fit.gradient(p, -prior * (1 - of_p) / len(p))
        # A negative risk below zero is overfitting: step back from it.
        gradient = positive_part + unlabelled_part if negative_risk >= 0 else -unlabelled_part
        fit.step(gradient, 0.05 if turn < steps // 2 else 0.01)
    return fit.model


def move_cut(model: Model, of_u: Histogram, of_p: np.ndarray, prior: float, cut: float) -> None:
    """Set the bias so that a score of ``cut`` lies between the logit above which the prior's
    share of unlabelled texts is and that which all but 0.2 % of the positives exceed, and never
    above the latter: no more positives are given up for a prior that is too low."""
    by_prior, by_positives = of_u.quantile(1 - prior), np.quantile(of_p, 0.002)
    boundary = min(by_positives, (by_prior + by_positives) / 2)
    model.bias += float(np.log(cut / (1 - cut)) - boundary)


def learn(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    histogram: Callable[[Model, bool], Histogram],
    *,
    bins: int = 24,
    steps: int = 1000,
    cut: float = 0.3,
) -> tuple[Model, float]:
    """The scorer and the estimated class prior.

    The first half of ``positive`` and all of ``unlabelled`` fit the classifier of the prior.
    ``histogram`` gives that of a model's logits over all rows, or over those that it was not
    fitted to.
    """
    bins = min(bins, max(4, min(len(positive), len(unlabelled)) // 25))
    edges = _edges(np.concatenate([positive, unlabelled]), bins)
    half = (len(positive) + 1) // 2
    first = fit_prior_scorer(positive[:half], unlabelled, edges, steps // 2)
    prior = estimate_prior(first.logits(positive[half:]), histogram(first, True))
    model = fit_non_negative(positive, unlabelled, edges, prior, steps)
    move_cut(model, histogram(model, False), model.logits(positive), prior, cut)
    return model, prior


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, x) of every row: the features of its text as 32-bit numbers."""
    texts = columns_of(docs, id=id_column, text=text_column)
    rows = texts.select(F.col("id").cast("long").alias("id"), text_of("text").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text).astype("<f4").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.binary())], names=["id", "x"])

    return rows.mapInArrow(measure, "id long, x binary")


def _rows_of(packed: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f4").reshape(-1, N_FEATURES).astype(float)


def _histogram(rows: DataFrame, model: Model) -> Histogram:
    def place_logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = Counter(Histogram.place_of(model.logits(_rows_of(batch.column("x").to_pylist()))).tolist())
            columns = [pa.array(list(places), pa.int64()), pa.array(list(places.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "n"])

    counted = rows.select("x").mapInArrow(place_logits, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    return Histogram({row["at"]: row["n"] for row in counted.collect()})


def train(
    docs: DataFrame,
    positives: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    most_positives: int = 20_000,
    most_unlabelled: int = 30_000,
) -> tuple[Model, float]:
    """A model from the ids in ``positives`` (one column ``id``) and all rows of ``docs``.

    ``most_positives`` labelled rows at most, and about ``most_unlabelled`` rows, are what the
    classifiers are fitted to. Up to half of a small table is, and the prior is read off the rest.
    """
    rows = durable(measured(docs, id_column, text_column))
    trusted = some_ids(positives.select("id").distinct(), most_positives)
    found = rows.join(F.broadcast(trusted), "id").toPandas().sort_values(["id", "x"])
    # By another hash than that of the id alone, so that the halves have nothing to do with it.
    mixed = np.random.default_rng(3).permutation(len(found))
    positive = _rows_of(found["x"].iloc[mixed].tolist())
    share = max(2, rows.count() // most_unlabelled)
    chosen = F.pmod(F.xxhash64("id", "x"), F.lit(share)) == 0
    unlabelled = _rows_of(sorted(rows.where(chosen).select("x").toPandas()["x"].tolist()))
    if len(positive) < 2 or len(unlabelled) < 2:
        return Model(np.zeros((N_FEATURES, 1)), np.zeros((N_FEATURES, 2)), 0.0), 0.5
    return learn(positive, unlabelled, lambda model, rest: _histogram(rows.where(~chosen) if rest else rows, model))


def score(
    docs: DataFrame,
    model: Model,
    *,
    text_column: str = "text",
    keep: list[str] | None = None,
    score_column: str = "score",
) -> DataFrame:
    """``docs``, or its columns ``keep``, with a column for the score."""
    names = [name for name in (docs.columns if keep is None else keep) if name.lower() != score_column.lower()]
    kept = [place(docs, name) for name in names]
    rows = numbered(docs).select(*kept, text_of(place(docs, text_column)).alias("text"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, texts = batch.columns
            found = np.array([features(text) for text in texts.to_pylist()]).reshape(-1, N_FEATURES)
            scores = pa.array(sigmoid(model.logits(found.astype("<f4").astype(float))), pa.float64())
            yield pa.RecordBatch.from_arrays([*columns, scores], names=[*kept, "score"])

    schema = T.StructType(rows.schema.fields[:-1]).add("score", "double")
    return rows.mapInArrow(apply, schema).toDF(*names, score_column)
