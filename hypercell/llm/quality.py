"""Quality classifier by Bradley-Terry ranking.

Each labelled pair of a better and a worse document is a preference; a logistic loss on the difference of their features
gives the weights of a score, and a quantile of the scores gives the threshold. All labelled documents and all their pairs
count: a pair's loss hangs on the difference of two scores only, so sums over pairs follow from each class's sums on a grid of
scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hypercell.llm.common import chunks, durable, id_text, lean, ship
from hypercell.llm.labelled import outside

#: Labelled rows of a partition, about, and how many partitions' sums are added up at once.
PART_ROWS, FAN = 50_000, 32
#: Nodes of the grid in a unit of the score. Between them a function of the score is the polynomial through ``len(_NEAR)`` nodes,
#: which is right to 1e-8 for the logistic function and its integral.
GRID = 8
_NEAR = np.arange(-2, 4)
#: The score at the threshold.
CUT = 0.7
#: Words of a stretch in which repeated words are counted.
STRETCH = 100

FEATURES = ("upper", "exclaim", "pipe", "symbol", "digit", "space", "stop", "word_length", "long_words", "repeats", "adjacent", "equal_lines", "marked", "short", "empty")

_CLASS = np.zeros(256, np.int8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!", b"|", b"#$%&*+<=>@[]^_`{}~\\/", b"0123456789", b" \t\r\n", b".,;:?")):
    _CLASS[list(_chars)] = _k + 1


def features(text: str) -> list[float]:
    """Shares of kinds of characters, word lengths, and repeated words and lines of a whole text."""
    data = text.encode()
    n = max(1, len(data))
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=8)
    words = text.lower().split()
    m = len(words)
    if not m:
        return [*(kinds[1:8] / n), 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0]
    fresh = sum(len(set(words[i : i + STRETCH])) for i in range(0, m, STRETCH))
    adjacent = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x]
    marked = sum(w[-1] in "!#$%&*|" for w in words)
    size = sum(map(len, words)) / m
    return [*(kinds[1:8] / n), min(size, 30.0), sum(len(w) > 25 for w in words) / m, 1 - fresh / m, adjacent / m, 1 - len(set(lines)) / max(1, len(lines)), marked / m, 1 / (1 + m / 20), 0.0]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    spread: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _weighted(_standard(x, self.mean, self.scale), self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        """From 0 to 1; ``CUT`` at the threshold."""
        z = (self.raw(x) - self.threshold) / self.spread + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _standard(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / scale, -8, 8)


def _weighted(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The same score of a row whatever rows stand beside it."""
    s = np.zeros(len(z))
    for column, weight in zip(z.T, w, strict=True):
        s += column * weight
    return s


# Sums by key: distinct keys in order, and a row of numbers for each. ``Total`` adds up what a function of features and labels
# finds in all rows.
Sums = tuple[np.ndarray, np.ndarray]
Total = Callable[[Callable[[np.ndarray, np.ndarray], Sums]], Sums]


def _added(found: list[Sums]) -> Sums:
    keys = np.concatenate([k for k, _ in found])
    order = np.argsort(keys, kind="stable")
    keys, at = np.unique(keys[order], return_index=True)
    return keys, np.add.reduceat(np.concatenate([v for _, v in found])[order], at, axis=0)


def _lagrange(u: np.ndarray) -> np.ndarray:
    """The weights of the nodes ``_NEAR`` for places from 0 to 1."""
    out = np.ones((len(u), len(_NEAR)))
    for i, a in enumerate(_NEAR):
        for b in _NEAR[_NEAR != a]:
            out[:, i] *= (u - b) / (a - b)
    return out


def _on_grid(x: np.ndarray, y: np.ndarray, mean: np.ndarray, scale: np.ndarray, w: np.ndarray) -> Sums:
    """By node and class (twice the node, plus the class): documents, and sums of their features and of the features' products."""
    z = _standard(x, mean, scale)
    i, j = np.triu_indices(len(w))
    f = np.concatenate([np.ones((len(z), 1)), z, z[:, i] * z[:, j]], axis=1)
    place = _weighted(z, w) * GRID
    cell = np.floor(place).astype(np.int64)
    near = _lagrange(place - cell)
    key = 2 * cell + y
    order = np.argsort(key, kind="stable")
    key, at = np.unique(key[order], return_index=True)
    groups = np.split(order, at[1:])
    return _added([(k + 2 * _NEAR, near[g].T @ f[g]) for k, g in zip(key, groups, strict=True)])


def _pairs(sums: Sums, d: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean loss over all pairs, its gradient with the sign changed, and its Hessian."""
    keys, v = sums
    node, bad = keys // 2 / GRID, keys % 2 == 0
    (sg, sb), (ng, nb), (zg, zb), (qg, qb) = ([part[~bad], part[bad]] for part in (node, v[:, 0], v[:, 1 : 1 + d], v[:, 1 + d :]))
    loss, grad, flat, cross = 0.0, np.zeros(d), np.zeros(qg.shape[1]), np.zeros((d, d))
    for a in range(0, len(sg), 1024):
        part = slice(a, a + 1024)
        gap = sb[None, :] - sg[part, None]
        p = 1 / (1 + np.exp(np.clip(-gap, -700, 700)))  # of the worse one winning
        h = p * (1 - p)
        loss += ng[part] @ np.logaddexp(0, gap) @ nb
        grad += (p @ nb) @ zg[part] - (ng[part] @ p) @ zb
        flat += (h @ nb) @ qg[part] + (ng[part] @ h) @ qb
        cross += zg[part].T @ h @ zb
    hessian = np.zeros((d, d))
    hessian[np.triu_indices(d)] = flat
    hessian += np.triu(hessian, 1).T - cross - cross.T
    n = ng.sum() * nb.sum()
    return loss / n, grad / n, hessian / n


def _ordered(s: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the scores."""
    bits = (s + 0.0).view(np.int64)  # one zero
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits)


def _ranked(total: Total, score: Callable[[np.ndarray], np.ndarray], ranks: tuple[int, int]) -> list[float]:
    """The scores of these ranks, from 0, among all: 16 bits at a time by counting."""
    found = [(None, r) for r in ranks]
    for shift in (48, 32, 16, 0):
        within = np.array([k for k, _ in found if k is not None], np.int64)

        def count(x: np.ndarray, y: np.ndarray, shift: int = shift, within: np.ndarray = within) -> Sums:
            key = _ordered(score(x)) >> shift
            if shift < 48:
                key = key[np.isin(key >> 16, within)]
            keys, n = np.unique(key, return_counts=True)
            return keys, n[:, None].astype(float)

        keys, n = total(count)
        for i, (above, r) in enumerate(found):
            mine = np.flatnonzero(keys >> 16 == above) if above is not None else np.arange(len(keys))
            ends = np.cumsum(n[mine, 0])
            at = int(np.searchsorted(ends, r, side="right"))
            found[i] = (int(keys[mine[at]]), r - int(ends[at] - n[mine[at], 0]))
    bits = np.array([k for k, _ in found], np.int64)
    return np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits).view(np.float64).tolist()


def _fit(total: Total, d: int, ridge: float, rounds: int) -> Model:
    keys, v = total(lambda x, y: _added([(np.array([k]), np.concatenate([[(y == k).sum()], x[y == k].sum(axis=0)])[None]) for k in (0, 1)]))
    count = dict(zip(keys.tolist(), v[:, 0].astype(int).tolist(), strict=True))
    k, n = count.get(0, 0), sum(count.values())
    mean = v[:, 1:].sum(axis=0) / n if n else np.zeros(d)
    scale = np.sqrt(total(lambda x, y: (np.array([0]), ((x - mean) ** 2).sum(axis=0)[None]))[1][0] / n) if n else np.ones(d)
    scale = np.where(scale > 1e-9, scale, 1.0)
    w = np.zeros(d)
    if not k or k == n:
        return Model(mean, scale, w, 0.0, 1.0)
    at, least, step = w, np.inf, w
    for _ in range(rounds):
        sums = total(lambda x, y, w=w: _on_grid(x, y, mean, scale, w))
        loss, grad, hessian = _pairs(sums, d)
        loss += ridge / 2 * w @ w
        if loss > least + 1e-6:  # too far
            step = step / 2
        else:
            at, least = w, loss
            step = np.linalg.solve(hessian + ridge * np.eye(d), grad - ridge * w)
        w = at + step
        if np.abs(step).max() < 1e-6:
            break
    low, high = _ranked(total, lambda x: _weighted(_standard(x, mean, scale), w), (k - 1, k))
    # Weights of the nodes add up to one, so these are sums over all rows.
    whole = sums[1].sum(axis=0)
    products = np.zeros((d, d))
    products[np.triu_indices(d)] = whole[1 + d :]
    products += np.triu(products, 1).T
    deviation = np.sqrt(max(0.0, w @ products @ w / n - (whole[1 : 1 + d] @ w / n) ** 2))
    return Model(mean, scale, w, (low + high) / 2, float(max(deviation / 4, 1e-6)))


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> Model:
    """Weights by Newton steps on the logistic loss of feature differences, better minus worse, over all pairs.

    The threshold lies at the quantile of the training scores that the worse documents fill. Without a preference (one class
    is empty) every document gets the score ``CUT``.
    """
    return _fit(lambda found: found(x, y), x.shape[1], ridge, rounds)


def _batch(part: int, sums: Sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "keys": pa.array([sums[0].astype("<i8").tobytes()], pa.binary()), "sums": pa.array([sums[1].astype("<f8").tobytes()], pa.binary())})


def _sums(keys: bytes, sums: bytes) -> Sums:
    k = np.frombuffer(keys, "<i8")
    return k, np.frombuffer(sums, "<f8").reshape(len(k), -1 if len(k) else 1)


def _total(rows: DataFrame, parts: int) -> Total:
    """Sums over the rows ``y`` and ``x`` of a table in so many partitions, added up in their order, so the same at every run."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, so_far = None, None
        for batch in batches:
            for part, keys, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if last is not None and part // FAN != last:
                    yield _batch(last, so_far)
                    so_far = None
                last = part // FAN
                so_far = _added([*([so_far] if so_far else []), _sums(keys, sums)])
        if last is not None:
            yield _batch(last, so_far)

    def total(found: Callable[[np.ndarray, np.ndarray], Sums]) -> Sums:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            so_far = None
            for batch in batches:
                if batch.num_rows:
                    x = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(batch.num_rows, -1)
                    new = found(x, np.asarray(batch.column(0)).astype(np.int64))
                    so_far = _added([so_far, new]) if so_far else new
            if so_far:
                yield _batch(TaskContext.get().partitionId(), so_far)

        kind = "part int, keys binary, sums binary"
        out, left = rows.select("y", "x").mapInArrow(lean(run), kind), parts
        while left > FAN:
            left = -(-left // FAN)
            out = out.repartition(left, F.expr(f"part div {FAN}")).sortWithinPartitions("part").mapInArrow(lean(merge), kind)
        got = [_sums(r["keys"], r["sums"]) for r in sorted(out.collect(), key=lambda r: r["part"])]  # at most ``FAN`` rows
        return _added(got) if got else (np.empty(0, np.int64), np.empty((0, 1 + len(FEATURES))))

    return total


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One checkpointed row per input row: ``id`` and the features of the text as binary, ``x``. A null text counts as empty."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1, 8 << 20):
                x = [np.array(features(t)).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x, pa.binary())], ["id", "x"])

    return durable(id_text(df, id_col, text_col).mapInArrow(lean(run), "id long, x binary"))


def train_measured(measured: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", folds: int = 1, held_out: int | None = None, ridge: float = 1e-3, rounds: int = 50) -> Model:
    """A model from all labelled rows outside the held-out fold (0: worse, 1: better) of what ``measure`` gave."""
    given = outside(labels, label_col, id_col, folds, held_out)
    parts = 1 + given.count() // PART_ROWS
    keys = ["id", "y", "x"]
    rows = durable(measured.join(given, "id").select(keys).repartition(parts, *keys).sortWithinPartitions(*keys))
    return _fit(_total(rows, parts), len(FEATURES), ridge, rounds)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", folds: int = 1, held_out: int | None = None) -> Model:
    """A model from all labelled documents outside the held-out fold (0: worse, 1: better)."""
    return train_measured(measure(docs, id_col, text_col), labels, label_col, id_col, folds, held_out)


def score_measured(measured: DataFrame, model: Model, id_col: str = "doc_id") -> DataFrame:
    """What ``score`` gives, from what ``measure`` gave."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shared.value.score(x))], ["id", "score"])

    return measured.mapInArrow(lean(run), "id long, score double").withColumnRenamed("id", id_col)


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and ``score``. Only the text counts; null texts are empty ones, which get a score
    too; null ids and repeated rows stay; other columns are left out."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in chunks(batch, 1, 8 << 20):
                x = np.array([features(t) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(m.score(x))], ["id", "score"])

    return id_text(df, id_col, text_col).mapInArrow(lean(run), "id long, score double").withColumnRenamed("id", id_col)


def keep(df: DataFrame, model: Model, cut: float = CUT, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores at least ``cut``; a null text counts as empty."""
    spark = df.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in chunks(batch, place, 8 << 20):
                x = np.array([features(t or "") for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(m.score(x) >= cut))

    return df.mapInArrow(lean(run), df.schema)
