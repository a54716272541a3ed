"""Hard negatives by exact scores from subset-sum tables (the method of the Four Russians).

Components become integers, floor(256 * x). A row's bit planes are packed by groups of eight dimensions, so one byte tells which of eight components
have a bit set. For every anchor and group a table holds the sums of all 256 subsets of the anchor's eight components; a score is then,
from the highest plane down, twice the score so far plus one looked-up sum per group (the sign plane counts negatively). These are the full exact inner
products; nothing is estimated or pruned.

Anchors are the queries, in blocks of at most about ``BLOCK``; all rows are the index, in slices of about ``SLICE``. Each block meets each slice
in a group of its own, so neither a hot label nor a hot vector makes a task larger than others. A group hands on at most ``positives``
rows per anchor in the first round (same label, only the slices of that label) and ``negatives`` rows per anchor and positive in the second; Spark merges
these by rank. Ties go to the smaller id.

Rows with a null id, label or vector, or with a null or non-finite component, take no part. A repeated id counts once, as its least label and
vector. Vectors may differ in length: missing components count as zero. An empty table, or one without anchors, gives no rows. An anchor without
another row of its label gives none either. Components and lengths may be as large as exact 64-bit scores allow; beyond that an error says so.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlake.llm.common import stored

BLOCK = 1024  # anchors whose tables a task holds at once: 2 KB per anchor and group of dimensions, 4 KB beyond 32-bit scores
SLICE = 4096  # rows scored against a block in one group
BINS = 64  # labels are told apart by a hash of this many values in the first round
CHUNK = 512  # rows per lookup, so that their scores stay in the processor's cache

PAIR = "anchor_id bigint, positive_id bigint, positive_score bigint, other_id bigint, score bigint"
LOWEST = np.iinfo(np.int64).min


def integer_rows(rows: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """id, label and integer components of the rows that take part, one per id."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))
    return (
        rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(finite, F.lit(False)))
        .select(
            F.col(id_col).cast("bigint").alias("id"),
            F.col(label_col).cast("bigint").alias("label"),
            F.transform(x, lambda c: F.floor(c * 256)).alias("v"),
        )
        .groupBy("id")
        .agg(F.min(F.struct("label", "v")).alias("row"))
        .select("id", "row.label", "row.v")
    )


def padded(vectors: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows of a matrix, filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    out = np.zeros((len(vectors), width), np.int64)
    if len(vectors):
        ends = vectors.offsets.to_numpy().astype(np.int64)
        size = np.diff(ends)
        flat = vectors.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        row = np.repeat(np.arange(len(vectors)), size)
        out[row, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], size)] = flat
    return out


def planes(v: np.ndarray, bits: int) -> np.ndarray:
    """Packed bit planes of integer rows, in two's complement: (rows, bits, groups) bytes, the highest plane first."""
    return np.stack([np.packbits((v >> b) & 1 == 1, axis=1, bitorder="little") for b in range(bits - 1, -1, -1)], axis=1)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): the sum of each subset of an anchor's eight components of a group."""
    groups = anchors.reshape(len(anchors), -1, 8).transpose(1, 2, 0).astype(kind)
    sums = np.zeros((groups.shape[0], 256, len(anchors)), kind)
    for j in range(8):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + groups[:, j : j + 1]
    return sums


def scores(sums: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(anchors, rows): exact inner products, by lookups and shifts."""
    out = np.empty((sums.shape[2], len(packed)), sums.dtype)
    for a in range(0, len(packed), CHUNK):
        part = packed[a : a + CHUNK]
        total = None
        for plane in range(part.shape[1]):
            now = np.zeros((len(part), sums.shape[2]), sums.dtype)
            for g in range(part.shape[2]):
                now += sums[g][part[:, plane, g]]
            total = -now if total is None else (total << 1) + now
        out[:, a : a + CHUNK] = total.T
    return out


class _Group:
    """One block of anchors against one slice: for each anchor the scores of the usable rows, ascending, ties by descending id."""

    def __init__(self, anchors: pa.Table, rows: pa.Table, width: int, bits: int, kind: type, same: bool):
        self.ids = rows["id"].to_numpy()
        order = np.argsort(-self.ids, kind="stable")
        self.ids = self.ids[order]
        packed = np.frombuffer(b"".join(rows["packed"].to_pylist()), np.uint8).reshape(len(self.ids), bits, width // 8)[order]
        self.anchor_ids = anchors["id"].to_numpy()
        usable = (anchors["label"].to_numpy()[:, None] == rows["label"].to_numpy()[order]) == same
        if same:
            usable &= self.anchor_ids[:, None] != self.ids
        self.scores = scores(subset_sums(padded(anchors["v"], width), kind), packed)
        self.order = np.argsort(self.scores, axis=1, kind="stable")
        self.usable = usable

    def top(self, anchor: int, n: int, low: int | None = None, high: int | None = None) -> list[tuple[int, int]]:
        """The n first (id, score) with low <= score <= high, highest first, ties by ascending id."""
        order = self.order[anchor]
        order = order[self.usable[anchor, order]]
        ascending = self.scores[anchor, order]
        last = len(order) if high is None else int(np.searchsorted(ascending, high, "right"))
        first = 0 if low is None else int(np.searchsorted(ascending, low, "left"))
        chosen = order[max(first, last - n) : last][::-1]
        return list(zip(self.ids[chosen].tolist(), self.scores[anchor, chosen].tolist(), strict=True))


def _as_table(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found, strict=True)) if found else [()] * 5
    names = [c.split()[0] for c in PAIR.split(", ")]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _positives(width: int, bits: int, kind: type, n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not (anchors.num_rows and rows.num_rows):
            return _as_table([])
        group = _Group(anchors, rows, width, bits, kind, same=True)
        return _as_table(
            [(a, None, None, i, s) for k, a in enumerate(group.anchor_ids.tolist()) for i, s in group.top(k, n)]
        )

    return run


def _negatives(width: int, bits: int, kind: type, n: int, low: int, high: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not (anchors.num_rows and rows.num_rows):
            return _as_table([])
        group = _Group(anchors, rows, width, bits, kind, same=False)
        found = []
        for k, (a, positives) in enumerate(zip(group.anchor_ids.tolist(), anchors["positives"].to_pylist(), strict=True)):
            for p in positives:
                s = p["score"]
                window = -(-low * s // 100), high * s // 100
                found += [(a, p["id"], s, i, t) for i, t in group.top(k, n, *window)]
        return _as_table(found)

    return run


def _cells(anchors: DataFrame, index: DataFrame, label_bin: Column, seed: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with bin, block and slice: every anchor meets every row of its bin in exactly one group.

    The counts that decide the number of blocks and slices are one row per bin, of which there are at most ``BINS``.
    """
    sides = [side.withColumn("bin", label_bin.cast("int")) for side in (anchors, index)]
    counts = [dict(side.groupBy("bin").count().collect()) for side in sides]
    parts = []
    for found, size in zip(counts, (BLOCK, SLICE), strict=True):
        by_bin = [-(-found.get(b, 0) // size) for b in range(BINS)]
        parts.append(F.element_at(F.array(*map(F.lit, by_bin)), F.col("bin") + 1))
    place = F.xxhash64("id", F.lit(seed))
    own = [F.pmod(place, n).cast("int") for n in parts]
    # A bin without rows on the other side has no cell to go to.
    every = [F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))) for n in parts]
    return (
        sides[0].select("*", own[0].alias("block"), every[1].alias("slice")),
        sides[1].select("*", own[1].alias("slice"), every[0].alias("block")),
    )


def _meet(anchors: DataFrame, index: DataFrame, label_bin: Column, work, seed: int) -> DataFrame:
    left, right = _cells(anchors, index, label_bin, seed)
    cell = ["bin", "block", "slice"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(work, PAIR)


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells by the column ``id`` which rows are queries. An anchor's positives are its best other rows of the same label;
    a positive's negatives are the best rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    """
    base = stored(integer_rows(rows, id_col, label_col, vector_col), "vectors")
    far = base.agg(
        F.max(F.array_max(F.transform("v", F.abs))).alias("largest"), F.max(F.size("v")).alias("length")
    ).first()
    largest, width = int(far["largest"] or 0), 8 * max(1, -(-(far["length"] or 0) // 8))
    bits = largest.bit_length() + 1
    reach = width * (1 << 2 * bits)  # no partial sum, shifted, gets beyond this
    if max(low, high, 100) * reach >= 1 << 63:
        raise ValueError(f"{width} components up to {largest} have scores beyond 64 bits")
    kind = np.int32 if reach < 1 << 31 else np.int64

    def pack(batches):
        for batch in batches:
            packed = planes(padded(batch.column(2), width), bits)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([p.tobytes() for p in packed], pa.binary())], names=["id", "label", "packed"]
            )

    index = stored(base.mapInArrow(pack, "id bigint, label bigint, packed binary"), "planes")
    queries = base.where(anchor)
    first = _meet(queries, index, F.pmod(F.xxhash64("label"), F.lit(BINS)), _positives(width, bits, kind, positives), 1)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    chosen = (
        first.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= positives)
        .groupBy(F.col("anchor_id").alias("id"))
        .agg(F.collect_list(F.struct(F.col("other_id").alias("id"), "score")).alias("positives"))
    )
    chosen = stored(queries.join(chosen, "id"), "positives")
    second = _meet(chosen, index, F.lit(0), _negatives(width, bits, kind, negatives, low, high), 2)
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "other_id")
    return (
        second.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("other_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
