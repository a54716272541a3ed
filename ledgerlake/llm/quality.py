"""Quality classifier: learned vectors of hashed words, character n-grams and word repeats, averaged per document, softmax output.

The model is trained by numpy stochastic gradient descent on a bounded sample of labelled documents (``max_rows``, chosen
by a hash of the id). Applying it needs one number per hashed feature, the difference of its two class logits, because averaging and the
output layer are linear up to the softmax: a fixed table of ``buckets`` floats goes to the tasks, and each whole text is the mean
over its features.

Null texts count as empty. A document without features gets the share of label 1 in the sample as its score. Repeated rows get a row each.
Labels that are null or belong to no document are not used; without any usable label every score is 0.5. Other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import U, mix, pieces, powers, text_of, utf8

BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
REPEATS = (1, 2, 3)
MAX_ROWS = 2000
DIMENSIONS = 8
EPOCHS = 4
RATE = 4.0
BATCH = 16
SEED = 20


@dataclass
class Model:
    """gain: per feature the logit of label 1 minus that of label 0; base: their difference without features; prior: share of label 1."""

    gain: np.ndarray
    base: float
    prior: float


def remainder(id_col: str, divisor: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % divisor


def _features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of feature numbers with the index of the text each belongs to: words, then n-grams inside blank-framed words."""
    n = len(offsets) - 1
    # Each text is framed by blanks; every blank becomes one and the same character.
    whole = bytes(data)
    texts = [whole[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    code = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le"), np.uint32).astype(U)
    if not len(code):
        return
    blank = (code == U(32)) | ((code >= U(9)) & (code <= U(13)))
    code[blank] = U(32)
    owner = np.repeat(np.arange(n), [len(t) + 2 for t in texts])
    solid = ~blank
    mask = U(buckets - 1)
    opens = np.flatnonzero(solid & np.concatenate([[True], blank[:-1]]))
    if len(opens):
        letters = mix(code[solid])
        closes = np.flatnonzero(solid & np.concatenate([blank[1:], [True]])) + 1
        lengths = closes - opens
        at = np.concatenate([[0], np.cumsum(lengths[:-1])])
        position = np.arange(len(letters)) - np.repeat(at, lengths)
        hashed = np.add.reduceat(letters * powers(int(lengths.max()))[position], at)
        yield ((mix(hashed) >> U(20)) & mask), owner[opens]
        # A word that repeats one of the few before it is a feature by itself, whatever the word.
        for back in REPEATS:
            near = np.flatnonzero(owner[opens[back:]] == owner[opens[:-back]])
            same = hashed[near + back] == hashed[near]
            yield np.where(same, U(2 * back), U(2 * back + 1)), owner[opens[near]]
    rolled = code.copy()
    for k in range(2, max(GRAMS) + 1):
        if len(code) < k:
            return
        rolled = rolled[:-1] * U(0x9E3779B97F4A7C15) + code[k - 1 :]
        if k in GRAMS:
            # Blanks may frame an n-gram but not stand inside it, and two words never meet in one.
            fine = solid[1 : len(rolled) + 1].copy() if k > 2 else solid[: len(rolled)] | solid[1:]
            for inner in range(2, k - 1):
                fine &= solid[inner : inner + len(rolled)]
            where = np.flatnonzero(fine)
            yield (((rolled[where] * U(0xBF58476D1CE4E5B9 + 2 * k)) >> U(40)) & mask), owner[where]


def _bags(buckets: int):
    """Per row: id, label, and the distinct features of the whole text with their shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for a, b in pieces(offsets):
                part = data[offsets[a] : offsets[b]]
                found = [(f, o) for f, o in _features(part, offsets[a : b + 1] - offsets[a], buckets)]
                feature = np.concatenate([f for f, _ in found]).astype(np.int64) if found else np.zeros(0, np.int64)
                owner = np.concatenate([o for _, o in found]) if found else np.zeros(0, np.int64)
                pairs, count = np.unique(owner * buckets + feature, return_counts=True)
                owner, feature = pairs // buckets, (pairs % buckets).astype(np.int32)
                total = np.bincount(owner, count, minlength=b - a)
                share = (count / np.maximum(total, 1)[owner]).astype(np.float32)
                at = np.searchsorted(owner, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(feature)),
                        pa.ListArray.from_arrays(pa.array(at), pa.array(share)),
                    ],
                    names=["sample_id", "label", "features", "shares"],
                )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    usable: Column | None = None,
    max_rows: int = MAX_ROWS,
    buckets: int = BUCKETS,
) -> Model:
    """Fit on at most max_rows labelled documents. usable: which rows of labels may be learned from."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if usable is not None:
        known = known.where(usable)
    picked = (
        known.groupBy(F.col(id_col).alias("sample_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
        .orderBy(F.xxhash64("sample_id"), "sample_id")
        .limit(max_rows)
    )
    # At most max_rows rows of two numbers: small enough to broadcast at any size of the corpus.
    texts = docs.select(F.col(id_col).alias("sample_id"), text_of(text_col).alias("body")).join(F.broadcast(picked), "sample_id")
    # Of rows that repeat an id one is learned from, so that the bound holds for rows, too.
    texts = texts.groupBy("sample_id", "label").agg(F.min_by("body", F.xxhash64("body")).alias("body"))
    kind = docs.schema[id_col].dataType.simpleString()
    bags = texts.select("sample_id", "label", "body").mapInArrow(
        _bags(buckets), f"sample_id {kind}, label int, features array<int>, shares array<float>"
    )
    rows = bags.toArrow().sort_by("sample_id")
    return fit(rows, buckets)


def fit(rows: pa.Table, buckets: int) -> Model:
    """Stochastic gradient descent over batches of documents; order and start depend on the seed alone."""
    label = np.asarray(rows["label"].to_numpy(), np.int64) if len(rows) else np.zeros(0, np.int64)
    if not len(label):
        return Model(np.zeros(buckets, np.float32), 0.0, 0.5)
    lists = rows["features"].combine_chunks()
    at = lists.offsets.to_numpy()
    feature = lists.values.to_numpy()
    share = rows["shares"].combine_chunks().values.to_numpy()
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-0.5, 0.5, (buckets, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * -(-len(label) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for first in range(0, len(order), BATCH):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            ids = order[first : first + BATCH]
            spans = [np.arange(at[i], at[i + 1]) for i in ids]
            where = np.concatenate(spans)
            owner = np.repeat(np.arange(len(ids)), [len(s) for s in spans])
            f, s = feature[where], share[where]
            hidden = np.zeros((len(ids), DIMENSIONS), np.float32)
            np.add.at(hidden, owner, vectors[f] * s[:, None])
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(ids)), label[ids]] -= 1
            # Per document, as fastText steps: the step of a document does not shrink with the batch.
            back = p @ out.T
            np.add.at(vectors, f, -rate * s[:, None] * back[owner])
            out -= rate * hidden.T @ p / len(ids)
            bias -= np.float32(0.1) * rate * p.sum(0) / len(ids)
    # Features the sample never showed keep no random vector: they say nothing about quality.
    seen = np.zeros(buckets, bool)
    seen[feature] = True
    gain = vectors @ (out[:, 1] - out[:, 0])
    gain[~seen] = 0
    return Model(gain.astype(np.float32), float(bias[1] - bias[0]), float(label.mean()))


def _apply(model, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            scores = [np.zeros(0)]
            for a, b in pieces(offsets):
                total, count = np.zeros(b - a), np.zeros(b - a)
                for feature, owner in _features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], buckets):
                    total += np.bincount(owner, m.gain[feature], minlength=b - a)
                    count += np.bincount(owner, minlength=b - a)
                logit = np.clip(total / np.maximum(count, 1) + m.base, -40, 40)
                scores.append(np.where(count > 0, 1 / (1 + np.exp(-logit)), m.prior))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score, the probability of label 1."""
    kind = docs.schema[id_col].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body")).mapInArrow(
        _apply(sent, len(model.gain)), f"doc_id {kind}, score double"
    )


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    model = train(docs, labels, "quality", id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_filter(sent, len(model.gain), docs.columns.index(text_col), threshold), docs.schema)


def _filter(model, buckets: int, text_at: int, threshold: float):
    apply = _apply(model, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pa.array(np.arange(batch.num_rows))
            scored = next(apply(iter([pa.RecordBatch.from_arrays([ids, batch.column(text_at)], names=["i", "t"])])))
            yield batch.filter(pa.array(scored.column(1).to_numpy() >= threshold))

    return run
