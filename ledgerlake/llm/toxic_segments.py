"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme-value statistics.

Learning uses a bounded sample of labelled documents (``max_rows``, by a hash of the id). Three quarters of it give counts, a quarter calibrates.

1. A token is a run of letters, A-Z and the accented Latin capitals folded. Each word is counted under its first 3 to 7 letters and as a whole.
   The share of toxic occurrences of a word starts from the Dirichlet prior that its shorter beginnings give, weighted like
   ``PRIOR`` occurrences, the shortest from the share among all words. The word's score is its log-odds against that share, less
   ``DRIFT``, so that clean text has a negative sum. Counts lie in two hashed tables of ``CELLS`` numbers: their size does not grow.
2. One linear scan per text finds all maximal-scoring segments (no extension or trimming raises their sum).
3. Under clean text the best segment of n words exceeds S with a chance of 1 - exp(-K n exp(-lambda S)). Lambda solves
   E[exp(lambda s)] = 1 over the scores of clean tokens, K is the maximum-likelihood value. A segment whose expected number of
   equals, K n exp(-lambda S), is at most ``SIGNIFICANT`` is a toxic passage.
4. A document's score is a logistic function of its best segment's excess, of all segments' excesses together, and of its mean score.

Null texts count as empty. A text without words gets the score of a document without any evidence. Without toxic and clean labels to
learn from, every score is the share of toxic labels (0.5 without labels) and there are no passages. Repeated rows get a row each; other
columns are not looked at. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import U, mix, pieces, powers, stored, text_of, utf8

MAX_ROWS = 16_000
CELLS = 1 << 21
PREFIXES = (3, 4, 5, 6, 7)
PRIOR = 4.0
DRIFT = 0.25
LOW, HIGH, STEP = -3.0, 8.0, 0.05
SIGNIFICANT = 0.05

_FOLD = np.arange(0x180, dtype=np.uint32)
_FOLD[0x41:0x5B] += 32
_FOLD[0xC0:0xDF] += 32
_FOLD[0xD7] = 0xD7


@dataclass
class Model:
    """toxic, every: occurrences by cell; root: share of toxic ones; lam, k: extreme-value parameters; weights: of the logistic function."""

    toxic: np.ndarray
    every: np.ndarray
    root: float
    lam: float = 1.0
    k: float = 1.0
    weights: tuple[float, ...] = ()
    prior: float = 0.5


def _tokens(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each level (-1 where a word is too short for it), first and last letter of each word, first word of each text."""
    code = np.frombuffer("".join(f"{t} " for t in texts).encode("utf-32-le"), np.uint32)
    small = code < 0x180
    code = np.where(small, _FOLD[np.where(small, code, 0)], code)
    letter = ((code >= 0x61) & (code <= 0x7A)) | ((code >= 0xC0) & (code != 0xD7) & (code != 0xF7) & ~((code >= 0x2000) & (code < 0x3000)))
    edge = np.diff(np.concatenate([[0], letter.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lengths = end - start
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first = np.searchsorted(start, bounds)
    if not len(start):
        return [np.zeros(0, np.int64)] * (len(PREFIXES) + 1), start, end, first
    at = np.concatenate([[0], np.cumsum(lengths)])
    position = np.arange(at[-1]) - np.repeat(at[:-1], lengths)
    summed = np.concatenate([[U(0)], np.cumsum(mix(code[letter]) * powers(int(lengths.max()))[position])])
    cells = []
    for k in PREFIXES:
        long = lengths > k
        cell = np.full(len(start), -1, np.int64)
        cell[long] = (mix(summed[at[:-1][long] + k] - summed[at[:-1][long]] + U(k)) % U(CELLS)).astype(np.int64)
        cells.append(cell)
    cells.append((mix(summed[at[1:]] - summed[at[:-1]] + U(99)) % U(CELLS)).astype(np.int64))
    return cells, start, end, first


def _scores(model: Model, cells: list[np.ndarray]) -> np.ndarray:
    """Per word its log-odds against the share among all words, less the drift."""
    share = np.full(len(cells[0]), model.root)
    for cell in cells:
        known = np.flatnonzero(cell >= 0)
        c = cell[known]
        share[known] = (model.toxic[c] + PRIOR * share[known]) / (model.every[c] + PRIOR)
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return np.clip(np.log(share / (1 - share)) - np.log(model.root / (1 - model.root)), LOW + DRIFT, HIGH + DRIFT) - DRIFT


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, end, sum) of a sequence, in linear time.

    Each candidate keeps its cumulative sum before and after; link leads to the nearest earlier one with a smaller sum before.
    """
    plus = scores > 0
    edge = np.diff(np.concatenate([[0], plus.view(np.int8), [0]]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    before, after = total[first].tolist(), total[end].tolist()
    found: list[list] = []  # first, end, before, after, link
    for a, b, low, high in zip(first.tolist(), end.tolist(), before, after, strict=True):
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                found.append([a, b, low, high, j])
                break
            a, low = found[j][0], found[j][2]
            link = found[j][4]
            del found[j:]
            j = link
    return [(a, b, high - low) for a, b, low, high, _ in found]


def remainder(id_col: str, divisor: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences by cell, toxic and all, of the rows of one task."""
    toxic, every = np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64)
    for batch in batches:
        label = batch.column(1).to_numpy()
        data, offsets = utf8(batch.column(2))
        for a, b in pieces(offsets):
            cells, start, _, first = _tokens(_texts(data, offsets, a, b))
            bad = np.repeat(label[a:b], np.diff(first)).astype(bool)
            for cell in cells:
                every += np.bincount(cell[cell >= 0], minlength=CELLS)
                toxic += np.bincount(cell[(cell >= 0) & bad], minlength=CELLS)
    used = np.flatnonzero(every)
    for a in range(0, len(used), 1 << 16):
        part = used[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(toxic[part]), pa.array(every[part])], names=["cell", "toxic", "every"])


def _texts(data: np.ndarray, offsets: np.ndarray, a: int, b: int) -> list[str]:
    whole = bytes(data[offsets[a] : offsets[b]])
    at = (offsets[a : b + 1] - offsets[a]).tolist()
    return [whole[x:y].decode("utf-8", "replace") for x, y in zip(at[:-1], at[1:], strict=True)]


def _calibrate(model):
    """Per sampled row: label, words, sum of scores, the sums of its segments, and a histogram of its scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in pieces(offsets):
                cells, _, _, first = _tokens(_texts(data, offsets, a, b))
                s = _scores(model.value, cells)
                own = [s[x:y] for x, y in zip(first[:-1], first[1:], strict=True)]
                bins = [np.bincount(((x - LOW) / STEP).astype(np.int64), minlength=int((HIGH - LOW) / STEP) + 2) for x in own]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(1).slice(a, b - a),
                        pa.array([len(x) for x in own], pa.int64()),
                        pa.array([float(x.sum()) for x in own]),
                        pa.array([[g[2] for g in segments(x)] for x in own], pa.list_(pa.float64())),
                        pa.array([x.tolist() for x in bins], pa.list_(pa.int64())),
                    ],
                    names=["label", "n", "total", "sums", "bins"],
                )

    return run


def _evidence(model: Model, sums: np.ndarray, n: int, total: float) -> list[float]:
    """What the logistic function sees: the best segment's excess, all excesses together, the mean score."""
    n = max(n, 1)
    excess = model.lam * sums - np.log(max(model.k * n, 1e-9)) if len(sums) else np.array([-5.0])
    positive = excess[excess > 0]
    return [float(np.clip(excess.max(), -5, 30)) / 5, float(np.log1p(positive.sum())), float(np.clip(total / n + DRIFT, -1, 2)) * 4, 1.0]


def _lambda(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1 for scores of negative mean, by bisection."""
    p = counts / counts.sum()
    if p @ values >= 0 or values[counts > 0].max() <= 0:
        return 1.0
    low, high = 1e-4, 1.0
    while np.log(p @ np.exp(high * values)) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if p @ np.exp(middle * values) < 1 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small ridge, by Newton's method."""
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 0.5)
    ridge[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    usable: Column | None = None,
    max_rows: int = MAX_ROWS,
) -> Model:
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        known = known.where(usable)
    picked = (
        known.groupBy(F.col(id_col).alias("sample_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("sample_id"), "sample_id")
        .limit(max_rows)
    )
    # At most max_rows rows of two numbers, whatever the size of the corpus.
    rows = docs.select(F.col(id_col).alias("sample_id"), text_of(text_col).alias("body")).join(F.broadcast(picked), "sample_id")
    # Of rows that repeat an id one is learned from, so that the bound holds for rows, too. Stored, for two passes follow.
    rows = stored(rows.groupBy("sample_id", "label").agg(F.min_by("body", F.xxhash64("body")).alias("body")), "toxic-sample")
    tests = F.pmod(F.xxhash64("sample_id", F.lit(1)), F.lit(4)) == 0
    counted = (
        rows.where(~tests)
        .mapInArrow(_counts, "cell bigint, toxic bigint, every bigint")
        .groupBy("cell")
        .agg(F.sum("toxic").alias("toxic"), F.sum("every").alias("every"))
        .select(F.col("cell").cast("int"), F.col("toxic").cast("int"), F.col("every").cast("int"))
        .toArrow()
    )  # at most CELLS rows
    toxic, every = np.zeros(CELLS, np.float32), np.zeros(CELLS, np.float32)
    cell = counted["cell"].to_numpy()
    toxic[cell], every[cell] = counted["toxic"].to_numpy(), counted["every"].to_numpy()
    root = float(toxic.sum(dtype=float) / max(every.sum(dtype=float), 1))
    model = Model(toxic, every, min(max(root, 1e-4), 1 - 1e-4))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    seen = rows.where(tests).mapInArrow(
        _calibrate(sent), "label int, n bigint, total double, sums array<double>, bins array<bigint>"
    ).toArrow()  # a quarter of max_rows rows
    y = np.asarray(seen["label"].to_pylist(), float)
    model.prior = float(y.mean()) if len(y) else 0.5
    if not len(y) or y.min() == y.max() or not toxic.any():
        model.prior = float(y.mean()) if len(y) else (root if len(cell) else 0.5)
        return model
    sums = [np.asarray(s) for s in seen["sums"].to_pylist()]
    n, total = np.asarray(seen["n"].to_pylist()), np.asarray(seen["total"].to_pylist())
    clean = np.flatnonzero(y == 0)
    bins = np.asarray(seen["bins"].to_pylist())[clean].sum(0)
    if bins.sum():
        model.lam = _lambda(LOW + STEP * (np.arange(len(bins)) + 0.5), bins)
        best = np.array([sums[i].max() if len(sums[i]) else 0.0 for i in clean])
        model.k = float(len(clean) / max((n[clean] * np.exp(-model.lam * best)).sum(), 1e-9))
    x = np.array([_evidence(model, sums[i], int(n[i]), float(total[i])) for i in range(len(y))])
    model.weights = tuple(_logistic(x, y).tolist())
    return model


def _apply(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in pieces(offsets):
                out, passages = np.full(b - a, m.prior), [[] for _ in range(b - a)]
                if m.weights:
                    texts = _texts(data, offsets, a, b)
                    cells, start, end, first = _tokens(texts)
                    shift = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
                    s = _scores(m, cells)
                    x = np.zeros((b - a, len(m.weights)))
                    for i in range(b - a):
                        own = s[first[i] : first[i + 1]]
                        found = segments(own)
                        x[i] = _evidence(m, np.array([g[2] for g in found]), len(own), float(own.sum()))
                        for p, q, total in found:
                            if m.k * len(own) * np.exp(-m.lam * total) <= SIGNIFICANT:
                                at, to = first[i] + p, first[i] + q - 1
                                passages[i].append({"start": int(start[at] - shift[i]), "end": int(end[to] - shift[i]), "sum": total})
                    out = 1 / (1 + np.exp(-np.clip(x @ np.array(m.weights), -30, 30)))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sum", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(out), pa.array(passages, kind)], names=["doc_id", "score", "passages"]
                )

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (chance that the document is toxic) and its toxic passages (start, end in code points, sum of scores)."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body")).mapInArrow(
        _apply(sent), f"doc_id {kind}, score double, passages array<struct<start:int,end:int,sum:double>>"
    )
