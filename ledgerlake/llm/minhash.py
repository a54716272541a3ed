"""Near duplicates by b-bit MinHash, confirmed on the full shingle sets.

1. One numpy pass over the whole texts hashes the words and their distinct shingles. Each text's set is cut into ``BINS`` bins by
   the leading bits of the hash; the minimum of each bin is kept, and an empty bin borrows the minimum of the first full bin in a
   random order of its own. Bands of minima hash into buckets; of each minimum only the low ``BITS`` bits are packed.
2. Equal sets are one class, represented by its smallest id, so exact copies cost a row each and no pair.
3. Within a bucket, each class meets the bucket's smallest class only (a star), never every other one. The signatures' equal
   bits, corrected for chance collisions, estimate the similarity; pairs far below the threshold go no further, the rest are confirmed
   on their full sets. Components of confirmed pairs are merged.
4. Whatever a bucket still holds outside its largest component meets the members of the bucket's other components, under the
   same estimate and confirmation, each pair once. After that each pair that shares a bucket and reaches the estimate is either
   confirmed, refuted, or already connected: no link is lost.

Candidates: ``BANDS`` bands of as many minima as keep the chance to miss a pair at the threshold below ``MISSED`` (7 at 0.8, 8 at 0.85).
The estimate's margin is five standard errors of as many independent minima as the smaller set can fill, and more
where these are few. Before it stands an exact test: two sets differ in at least as many shingles as their bitmaps, which have a bit for each
shingle's hash among ``MAP_LONGS`` * 64, differ in bits. It refutes most pairs of sets up to some thousand shingles, also those that just miss the
threshold, and never a link. Words are maximal runs of characters other than blanks, A-Z folded; a text with fewer words than a shingle has its whole
sequence as one; without words (null, empty or blank text) the set is empty and linked with nothing. Rows that repeat a doc_id are not
expected to differ: they get a row each and the component of their set. Other columns are not looked at. A null doc_id gets its set's size,
a null component, and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import U, apart, discard, mix, pieces, seeds, stored, text_of, utf8, words
from ledgerlake.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 80  # per cent
BINS = 1024  # a power of two
BANDS = 72
MOST_ROWS, MISSED = 8, 1e-7
BITS = 2  # kept of each minimum
LONGS = BINS * BITS // 64
ERRORS = 5  # standard errors below the threshold that an estimate may lie
TAIL = 12  # further margin, over the number of independent minima: the fewer, the longer the distribution's tail
MAP_LONGS = 32  # of a set's bitmap, a power of two

TRIES = 32
_ORDER, _BAND = seeds(16, 5), seeds(16, 6)


@cache
def _borrowing() -> tuple[np.ndarray, np.ndarray]:
    """For each bin the first bins of its random order of all bins, and each bin's rank in it."""
    random = mix(np.arange(BINS * BINS, dtype=U) + U(77)).reshape(BINS, BINS)
    order = np.argsort(random, axis=1).astype(np.int16)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(BINS, dtype=np.int16)[None, :], axis=1)
    return order[:, :TRIES].copy(), rank


def band_rows(threshold: int) -> int:
    """The most minima per band with which a pair at the threshold is missed with a chance below MISSED."""
    fits = [r for r in range(1, MOST_ROWS + 1) if (1 - (threshold / 100) ** r) ** BANDS < MISSED]
    return max(fits, default=1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of several texts, and where each text's begin (with the total last)."""
    hashed, _, first = words(data, offsets)
    count = np.diff(first)
    length = np.where(count >= width, count - width + 1, (count > 0).astype(np.int64))
    out = np.zeros(int(length.sum()), U)
    at = np.concatenate([[0], np.cumsum(length)])
    if len(hashed) >= width:
        rolled = np.zeros(len(hashed) - width + 1, U)
        for k in range(width):
            rolled += hashed[k : k + len(rolled)] * _ORDER[k]
        rolled = mix(rolled)
    for i in np.flatnonzero(length):
        if count[i] >= width:
            part = np.sort(rolled[first[i] : first[i] + length[i]])
        else:
            part = mix((hashed[first[i] : first[i + 1]] * _ORDER[: count[i]]).sum(keepdims=True, dtype=U) + U(int(count[i])))
        out[at[i] : at[i + 1]] = part
    owner = np.repeat(np.arange(len(count)), length)
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return out[fresh], np.concatenate([[0], np.cumsum(np.bincount(owner[fresh], minlength=len(count)))])


def minima(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text and bin the smallest hash; empty bins borrow along a fixed random order. Rows of empty sets are zero."""
    n = len(at) - 1
    owner = np.repeat(np.arange(n), np.diff(at))
    cell = owner * BINS + (sets >> U(64 - BINS.bit_length() + 1)).astype(np.int64)
    lead = np.ones(len(cell), bool)
    lead[1:] = cell[1:] != cell[:-1]  # sets are sorted, so a bin's first hash is its minimum
    out, full = np.zeros(n * BINS, U), np.zeros(n * BINS, bool)
    out[cell[lead]], full[cell[lead]] = sets[lead], True
    out, full = out.reshape(n, BINS), full.reshape(n, BINS)
    tries, rank = _borrowing()
    row, bin_ = np.nonzero(~full & full.any(1, keepdims=True))
    for t in range(TRIES):
        if not len(row):
            return out
        source = tries[bin_, t]
        found = full[row, source]
        out[row[found], bin_[found]] = out[row[found], source[found]]
        row, bin_ = row[~found], bin_[~found]
    for r in np.unique(row):  # texts of few shingles: the same choice, by rank among the few full bins
        own, filled = bin_[row == r], np.flatnonzero(full[r])
        out[r, own] = out[r, filled[rank[own][:, filled].argmin(1)]]
    return out


def bitmaps(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A bit for each shingle, by a hash of its own: (texts, MAP_LONGS)."""
    n = len(at) - 1
    bits = np.zeros((n, MAP_LONGS * 64), bool)
    bits[np.repeat(np.arange(n), np.diff(at)), mix(sets + U(9)) >> U(64 - (MAP_LONGS * 64).bit_length() + 1)] = True
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def _sketch(width: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in pieces(offsets):
                sets, at = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                size = np.diff(at)
                total = [np.concatenate([[U(0)], np.cumsum(mix(sets + salt))]) for salt in (U(3), U(5))]
                digest = [(t[at[1:]] - t[at[:-1]]).view(np.int64) for t in total]
                low = minima(sets, at)
                bits = (low & U((1 << BITS) - 1)) << (U(BITS) * (np.arange(BINS, dtype=U) % U(64 // BITS)))
                packed = np.bitwise_or.reduce(bits.reshape(b - a, LONGS, -1), axis=2).view(np.int64)
                bands = low[:, : BANDS * rows].reshape(b - a, BANDS, rows)
                bands = mix((bands * _BAND[:rows]).sum(2, dtype=U) + np.arange(BANDS, dtype=U)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(size),
                        pa.array(digest[0]),
                        pa.array(digest[1]),
                        _lists(packed),
                        _lists(bitmaps(sets, at)),
                        _lists(bands),
                    ],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature", "bitmap", "bands"],
                )

    return run


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, m = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * m), pa.array(matrix.ravel()))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for a, b in pieces(offsets):
                sets, at = shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(sets.view(np.int64))),
                    ],
                    names=["rep", "shingles"],
                )

    return run


def estimated(a: Column, b: Column) -> Column:
    """Similarity from equal b-bit minima: the share that agrees, less what agrees by chance."""
    low = sum(1 << i for i in range(0, 64, BITS)) - (1 << 64 if BITS == 1 else 0)
    differ = F.lit(0)
    for k in range(LONGS):
        x = a[k].bitwiseXOR(b[k])
        folded = x
        for s in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        differ = differ + F.bit_count(folded.bitwiseAND(F.lit(low)))
    chance = 1 / (1 << BITS)
    return ((1 - differ / BINS) - chance) / (1 - chance)


def _floor(threshold: int, size: Column) -> Column:
    """The least estimate at which a pair is still confirmed, by the number of shingles of its smaller set.

    Such a set fills some bins; the others borrow from these, so that some minima count several times. draws: the number of
    independent minima whose mean varies as much.
    """
    chance = 1 / (1 << BITS)
    agree = chance + (1 - chance) * threshold / 100
    full = BINS * (1 - F.exp(-size / BINS))
    draws = full / (1 + full * (BINS - full) / BINS**2)
    margin = ERRORS * F.sqrt(agree * (1 - agree) / draws) + TAIL * (1 / draws - 1 / BINS)
    return threshold / 100 - margin / (1 - chance)


def _fitting(pairs: DataFrame, about: DataFrame, threshold: int) -> DataFrame:
    """Of candidate pairs (a, b) those whose sizes and estimate allow the similarity."""
    for side in ("a", "b"):
        pairs = pairs.join(
            about.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"n_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in ("signature", "bitmap")]),
            side,
        )
    return pairs.where(_possible(threshold)).select("a", "b")


def _possible(threshold: int) -> Column:
    n_a, n_b = F.col("n_a"), F.col("n_b")
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * threshold
    a, b = F.col("bitmap_a"), F.col("bitmap_b")
    differ = F.lit(0)
    for k in range(MAP_LONGS):
        differ = differ + F.bit_count(a[k].bitwiseXOR(b[k]))
    # Sets that reach the threshold differ in at most this share of their sizes' sum.
    near = differ * (100 + threshold) <= (n_a + n_b) * (100 - threshold)
    # In the order of their cost: what is false already is not computed further.
    enough = estimated(F.col("signature_a"), F.col("signature_b")) >= _floor(threshold, F.least(n_a, n_b))
    return F.when(~sizes, False).when(~near, False).otherwise(enough)


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, threshold: int) -> DataFrame:
    """Of stored pairs (a, b) of ids those whose full shingle sets reach the threshold."""
    involved = stored(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), "near-involved")
    kind = docs.schema["rep"].dataType.simpleString()
    sets = stored(
        docs.join(involved, "rep", "left_semi").mapInArrow(_sets(width), f"rep {kind}, shingles array<bigint>").dropDuplicates(["rep"]),
        "near-sets",
    )
    full = pairs
    for side in ("a", "b"):
        full = full.join(sets.select(F.col("rep").alias(side), F.col("shingles").alias(f"set_{side}")), side)
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    links = stored(full.where(both * 100 >= union * threshold).select("a", "b"), "near-links")
    discard(involved, sets)
    return links


def _mixed(crowded: DataFrame, about: DataFrame, links: DataFrame) -> DataFrame:
    """The members of buckets that hold several components: bucket, band, rep, part, main (the bucket's largest), n, signature, bitmap, tags."""
    joined = connected_components(links, "a", "b")
    part = crowded.join(joined, crowded["rep"] == joined["node"], "left").select(
        "bucket", "band", "rep", F.coalesce("component", "rep").alias("part")
    )
    sizes = part.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    found = part.join(main.select("bucket", F.col("top.part").alias("main")), "bucket")
    # Of each band's hash 31 bits are enough to see which is the first that two classes share.
    tags = F.transform("bands", lambda b: (b % ((1 << 31) - 1)).cast("int")).alias("tags")
    return found.join(about.select("rep", F.col("n_shingles").alias("n"), "signature", "bitmap", tags), "rep")


def _across(mixed: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and fit, one of the two outside the bucket's largest.

    Two members may share many buckets; the first of these alone gives the pair.
    """

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.select("bucket", F.col("band").alias(f"band_{s}"), F.col("rep").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("part", "n", "signature", "bitmap", "tags")])

    agree = F.zip_with("tags_a", "tags_b", lambda x, y: x == y)
    first = F.array_position(agree, F.lit(True)) == F.col("band_a") + 1
    # In the order of their cost: what is false already is not computed further.
    fits = F.when(F.col("part_a") == F.col("part_b"), False).when(~_possible(threshold), False).otherwise(first)
    pairs = side(mixed.where("part != main"), "a").join(side(mixed, "b"), "bucket").where(fits)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept."""
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body"))
    sketch = stored(
        source.mapInArrow(
            _sketch(shingle, band_rows(threshold)),
            f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, signature array<bigint>, bitmap array<bigint>, bands array<bigint>",
        ),
        "near-sketch",
    )
    same = ["n_shingles", "set_a", "set_b"]
    classes = stored(
        sketch.where("n_shingles > 0").groupBy(*same).agg(F.min("doc_id").alias("rep")).where("rep IS NOT NULL"), "near-classes"
    )
    # (size, digests) belong to one class, so a row whose id is the class's smallest represents it.
    of_reps = sketch.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "left_semi").withColumnRenamed("doc_id", "rep")
    about = stored(of_reps.select("rep", "n_shingles", "signature", "bitmap", "bands").dropDuplicates(["rep"]), "near-about")
    rows = stored(sketch.select("doc_id", *same), "near-rows")
    discard(sketch)
    member = about.select("rep", F.posexplode("bands").alias("band", "bucket"))
    leaders = member.groupBy("bucket").agg(F.min("rep").alias("leader"), F.count("*").alias("n")).where("n > 1")
    crowded = stored(member.join(leaders.select("bucket", "leader"), "bucket"), "near-buckets")
    texts = source.withColumnRenamed("doc_id", "rep")

    stars = crowded.where("rep != leader").select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct()
    tested = stored(_fitting(stars, about, threshold), "near-candidates")
    links = _confirmed(tested, texts, shingle, threshold)
    mixed = stored(_mixed(crowded, about, links), "near-mixed")
    discard(crowded, about)
    rest = stored(_across(mixed, threshold).join(tested, ["a", "b"], "left_anti"), "near-candidates")
    discard(mixed, tested)
    links = links.union(_confirmed(rest, texts, shingle, threshold))
    whole = stored(connected_components(links, "a", "b"), "near-components")

    of_class = (
        classes.join(whole, classes["rep"] == whole["node"], "left")
        .select(*same, F.coalesce("component", "rep").alias("component_id"))
    )
    found = rows.join(of_class, same, "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns."""
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = stored(found.where("not kept").select(F.col("doc_id").alias("gone_id")), "near-gone")
    stay, maybe = apart(docs, id_col, gone)
    return stay.union(maybe.join(gone, maybe[id_col] == gone["gone_id"], "left_anti"))
