"""What the operators of this package share: session settings, written tables, reading texts as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.session import scratch
from ledgerlake.sources.tables import remove

# The characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
# Bytes of text handled at once inside a task, so that numpy's working arrays stay small.
PIECE_BYTES = 1 << 20
# Whether a query's shuffle files go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Bits of a bitmap per id that it marks, and at most (8 MB).
BITS_PER_ID, MOST_BITS = 32, 1 << 26

U = np.uint64


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every operator relies on; all of them can be set on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A hot key is split between tasks even if a later aggregate then needs one more shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Small Arrow batches bound a Python worker's memory when texts are long.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors, and gives Catalyst a size.

    What the write's joins and sums exchanged is removed with its end, not when the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*copies: DataFrame) -> None:
    """Remove what ``stored`` wrote, once everything made from it is written itself."""
    for df in copies:
        remove(df.sparkSession, df.stored_at)


def apart(docs: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose id is surely not among ``ids`` (one column, stored), and all others: those whose id is, and a few more.

    A broadcast bitmap of hashed ids tells them apart, so that a join with the ids need exchange the second kind alone. Beyond MOST_BITS / BITS_PER_ID
    ids more rows than needed are of the second kind.
    """
    size = min(max(BITS_PER_ID * ids.count(), 1), MOST_BITS)

    def place(id_: Column) -> Column:
        return F.pmod(F.xxhash64(id_), F.lit(size))

    marked = place(ids[ids.columns[0]])
    bitmap = F.broadcast(
        ids.groupBy(F.bitmap_bucket_number(marked).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(marked)).alias("bits"))
    )
    own = place(docs[id_col])
    bit = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring(bitmap["bits"], (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    among = (F.bitmap_bucket_number(own) == bitmap["part"]) & (F.getbit(byte, bit % 8) == 1)
    return docs.join(bitmap, among, "left_anti"), docs.join(bitmap, among, "left_semi")


def text_of(column: str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its values; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_utf8())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole values with about ``size`` bytes each; a longer value is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers whose output bits all depend on all input bits."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on nothing but the seed."""
    return mix((np.arange(1, n + 1, dtype=U) + U(seed * 1_000_003)) * U(0x9E3779B97F4A7C15)) | U(1)


_BYTES = seeds(256, 11)
_POWER = 0x9E3779B97F4A7C15 | 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in BLANKS]] = True


def powers(n: int) -> np.ndarray:
    """1, p, p**2 and so on, modulo 2**64."""
    out = np.full(max(n, 1), U(_POWER))
    out[0] = 1
    return np.multiply.accumulate(out)


def words(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the blank-separated words of several texts, A-Z folded to a-z.

    Returns the hashes in order, each word's first byte, and the index of each text's first word (with the total last).
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    solid = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1] | edge[1:-1]
    closes[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(starts):
        return np.zeros(0, U), starts, np.zeros(n + 1, np.int64)
    letters = data[solid]
    if fold:
        letters = _FOLD[letters]
    lengths = ends - starts
    at = np.zeros(len(starts), np.int64)
    np.cumsum(lengths[:-1], out=at[1:])
    position = np.arange(len(letters)) - np.repeat(at, lengths)
    hashed = np.add.reduceat(_BYTES[letters] * powers(int(lengths.max()))[position], at)
    hashed = mix(hashed + lengths.astype(U))
    return hashed, starts, np.searchsorted(starts, offsets)
