"""Toxicity by weak supervision.

A lexicon is induced from labelled training rows. Its terms and some patterns are voters; a generative model over their
votes estimates, without labels, how often each votes in either class and which voters repeat each other, and gives
posterior labels, on which a linear classifier is trained.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercell.llm.common import chunks, durable, id_text, lean, ship
from hypercell.llm.labelled import MAX_TRAINING_ROWS, sample, with_labels

#: A term stands in at least so many toxic training documents, and its odds there are so many times those elsewhere.
MIN_DOCS, MIN_ODDS = 3, 8.0
#: Least lower confidence bound of the share of toxic documents among those that hold a term, and the bound's normal quantile.
LEAST_PRECISION, QUANTILE = 0.5, 1.96
#: Lengths of the word beginnings that are terms beside whole words.
PREFIXES = (4, 5, 6)

_WORD = re.compile(r"[^\W\d_]+")


def terms(text: str) -> set[str]:
    """Distinct lower-case words, and their beginnings with a star."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + "*" for w in words if len(w) >= n)
    return out


@dataclass
class Lexicon:
    terms: list[str]
    index: dict[str, int] = field(init=False)
    prefixes: dict[int, dict[str, int]] = field(init=False)

    def __post_init__(self) -> None:
        self.index = {t: i for i, t in enumerate(self.terms) if not t.endswith("*")}
        self.prefixes = {n: {t[:-1]: i for i, t in enumerate(self.terms) if t.endswith("*") and len(t) == n + 1} for n in PREFIXES}

    def hits(self, text: str) -> tuple[list[int], int, int]:
        """Terms that occur, occurrences of words that any term fits, and words."""
        words = _WORD.findall(text.lower())
        found: set[int] = set()
        bad = set()
        distinct = set(words)
        for w in distinct & self.index.keys():
            found.add(self.index[w])
            bad.add(w)
        for n, table in self.prefixes.items():
            if table:
                for w in distinct:
                    i = table.get(w[:n])
                    if i is not None and len(w) >= n:
                        found.add(i)
                        bad.add(w)
        return sorted(found), sum(w in bad for w in words) if bad else 0, len(words)


# Pattern voters beside the terms: (name, vote, rule on the number of terms, occurrences and words).
PATTERNS = (
    ("no term", 0, lambda t, h, n: h == 0),
    ("two terms", 1, lambda t, h, n: t >= 2),
    ("two occurrences", 1, lambda t, h, n: h >= 2),
    ("dense", 1, lambda t, h, n: n > 0 and 100 * h >= n),
    ("empty", 0, lambda t, h, n: n == 0),
)


def votes(found: list[tuple[list[int], int, int]], n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Which voters spoke on which document, and each voter's class."""
    v = np.zeros((len(found), n_terms + len(PATTERNS)), np.float32)
    for i, (t, h, n) in enumerate(found):
        v[i, t] = 1
        for k, (_, _, rule) in enumerate(PATTERNS):
            v[i, n_terms + k] = rule(len(t), h, n)
    return v, np.array([1] * n_terms + [p[1] for p in PATTERNS])


@dataclass
class LabelModel:
    """How often each voter speaks in each class, what share of its evidence is its own, and the classes' shares."""

    rate: np.ndarray
    own: np.ndarray
    prior: float

    def posterior(self, v: np.ndarray) -> np.ndarray:
        spoke = np.log(self.rate[1] / self.rate[0]) * self.own
        silent = np.log((1 - self.rate[1]) / (1 - self.rate[0])) * self.own
        z = np.log(self.prior / (1 - self.prior)) + v @ (spoke - silent) + silent.sum()
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def fit_label_model(v: np.ndarray, side: np.ndarray, times: np.ndarray | None = None, rounds: int = 30) -> LabelModel:
    """Expectation maximisation, started from the majority of votes. Between rounds the voters' correlations within the classes
    are estimated; a voter that others repeat shares its evidence with them. ``times``: how often each row occurs."""
    d = v.shape[1]
    times = np.ones(len(v)) if times is None else times
    n = times.sum()
    p = np.clip(0.5 + 0.4 * np.sign(v @ np.where(side == 1, 1.0, -1.0) - 1e-3), 0.1, 0.9)
    own = np.ones(d)
    model = LabelModel(np.full((2, d), 0.5), own, 0.5)
    for k in range(rounds):
        w = np.stack([1 - p, p]) * times
        rate = np.clip((w @ v + 0.1) / (w.sum(axis=1, keepdims=True) + 1.0), 1e-4, 1 - 1e-4)
        if k % 5 == 0:
            rest = v - (np.stack([1 - p, p], axis=1) @ rate)
            cov = (rest * times[:, None]).T @ rest / max(1, n)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            corr = cov / np.outer(sd, sd)
            np.fill_diagonal(corr, 0)
            own = 1 / (1 + np.where(corr > 0.1, corr, 0).sum(axis=1))
        model = LabelModel(rate, own, float(np.clip((p * times).sum() / max(1, n), 1e-3, 1 - 1e-3)))
        new = model.posterior(v)
        if np.abs(new - p).max() < 1e-6 and k > 5:
            break
        p = new
    return model


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, texts: list[str]) -> np.ndarray:
        x = _design([self.lexicon.hits(t) for t in texts], len(self.lexicon.terms))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -60, 60)))


def _design(found: list[tuple[list[int], int, int]], n_terms: int) -> np.ndarray:
    x = np.zeros((len(found), n_terms + 4))
    for i, (t, h, n) in enumerate(found):
        x[i, t] = 1
        x[i, n_terms:] = (1, h > 0, np.log1p(h), min(1.0, 20 * h / max(1, n)))
    return x


def fit_linear(x: np.ndarray, p: np.ndarray, times: np.ndarray | None = None, ridge: float = 1e-3, rounds: int = 25) -> np.ndarray:
    """Logistic regression on soft labels, by Newton steps. ``times``: how often each row occurs."""
    d = x.shape[1]
    times = np.ones(len(x)) if times is None else times
    n = times.sum()
    w = np.zeros(d)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        step = np.linalg.solve((x * (times * q * (1 - q))[:, None]).T @ x / n + ridge * np.eye(d), x.T @ (times * (p - q)) / n - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _counted(src: DataFrame) -> DataFrame:
    """Toxic and clean documents that hold each term: ``term``, ``a`` and ``b``; those terms that may be in a lexicon."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            keys = list(seen)
            out = pa.RecordBatch.from_arrays([pa.array([t for t, _ in keys], pa.string()), pa.array([y for _, y in keys], pa.int32()), pa.array(list(seen.values()), pa.int64())], ["term", "y", "docs"])
            seen.clear()
            return out

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.update((t, y) for t in terms(text))
                if len(seen) > 200_000:
                    yield flush()
        if seen:
            yield flush()

    counts = src.select("text", "y").mapInArrow(lean(run), "term string, y int, docs long").groupBy("term")
    counts = counts.agg(F.sum(F.when(F.col("y") == 1, F.col("docs")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("docs")).otherwise(0)).alias("b"))
    # The same bound as lower_bound has, with some room for rounding.
    a, n, z = F.col("a"), F.col("a") + F.col("b"), QUANTILE * QUANTILE
    bound = (a + z / 2 - QUANTILE * F.sqrt(a * (n - a) / n + z / 4)) / (n + z)
    return counts.where((a >= MIN_DOCS) & (bound >= LEAST_PRECISION - 1e-9))


def lower_bound(a: int, n: int) -> float:
    """Wilson's lower bound of a share of which ``a`` of ``n`` are seen."""
    z = QUANTILE * QUANTILE
    return float((a + z / 2 - QUANTILE * np.sqrt(a * (n - a) / n + z / 4)) / (n + z))


def induce(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> list[str]:
    """Terms by how far their odds in toxic documents exceed those in clean ones, of several toxic documents each. A term that
    a few clean documents hold too stays; the label model weighs it."""
    ranked = []
    for t, a in toxic.items():
        b = clean.get(t, 0)
        odds = ((a + 0.5) / (n_toxic - a + 0.5)) / ((b + 0.5) / (n_clean - b + 0.5))
        if a >= MIN_DOCS and odds >= MIN_ODDS and lower_bound(a, a + b) >= LEAST_PRECISION:
            ranked.append((-a * np.log(odds), t))
    return [t for _, t in sorted(ranked)]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", folds: int = 1, held_out: int | None = None, limit: int = MAX_TRAINING_ROWS) -> Model:
    """A model from at most ``limit`` labelled documents outside the held-out fold; that bounds the lexicon too. Labels only choose
    the lexicon; without toxic rows or terms every document gets a score below one half."""
    spark = docs.sparkSession
    ship(spark)
    rows = sample(labels, label_col, id_col, folds, held_out, limit)
    n_toxic = sum(y for _, y in rows)
    lexicon = Lexicon([])
    if n_toxic:
        src = durable(with_labels(id_text(docs, id_col, text_col), rows))  # as many rows as the sample
        counts = _counted(src).collect()
        lexicon = Lexicon(induce({r["term"]: r["a"] for r in counts}, {r["term"]: r["b"] for r in counts}, n_toxic, len(rows) - n_toxic))
    k = len(lexicon.terms)
    if not k:
        w = np.zeros(4)
        w[0] = -2.0
        return Model(lexicon, w)
    shared = spark.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shared.value.hits(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.int64()), pa.array([g[2] if g[1] else min(g[2], 1) for g in got], pa.int64())], ["t", "h", "n"])

    # Without a term only whether there are words matters, so most documents are alike.
    alike = src.select("text").mapInArrow(lean(run), "t array<int>, h long, n long").groupBy("t", "h", "n").agg(F.count("*").alias("times"))
    got = sorted((list(r["t"]), r["h"], r["n"], r["times"]) for r in alike.collect())
    found, times = [(t, h, n) for t, h, n, _ in got], np.array([r[3] for r in got], float)
    v, side = votes(found, k)
    posterior = fit_label_model(v, side, times).posterior(v)
    return Model(lexicon, fit_linear(_design(found, k), posterior, times))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and ``score`` from 0 to 1. Only the text counts; null texts are empty ones, which get a
    score too; null ids and repeated rows stay; other columns are left out."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in chunks(batch, 1, 4 << 20):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m.score(part.column(1).to_pylist()))], ["id", "score"])

    return id_text(df, id_col, text_col).mapInArrow(lean(run), "id long, score double").withColumnRenamed("id", id_col)
