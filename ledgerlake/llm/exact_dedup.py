"""Exact duplicates through an extendible-hash index on shared files. DataFrame operations only.

Texts are equal when identical after deleting blanks (space, tab, LF, VT, FF, CR). A text's key is the top ``hash_bits`` of
its 64-bit hash; the directory looks at the leading bits of the key.

1. Each row's key, SHA-256 and length are written once. Keys that only one row has need no comparison.
2. Rows of shared keys are chained: grouped by key and by the normalised bytes themselves, reduced in each task first,
   so a text that a third of all rows hold crosses the network as one row per task.
3. The directory doubles until no bucket holds more than ``capacity`` keys (or bits run out: then the bucket chains on). Only overfull buckets split:
   a bucket's own depth is the fewest leading bits that leave it with no more keys than fit, so cells of the directory share buckets.
4. The index is written in ranges of buckets, each sorted by one owner task. Each row finds its cell by its key's leading bits, there the
   bucket, and in the bucket its chain.

Null texts count as empty; empty texts are equal to each other. Ids may be of any type that can be ordered; a null doc_id loses every tie. Rows that
repeat both a doc_id and a text count as rows in the result; of these the stage keeps one, the longest as written. Columns other than id and text are not looked at, whatever
their names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log2

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import BLANKS, apart, discard, stored, text_of

CAPACITY = 4096


@dataclass
class Index:
    """entries: bucket, depth, key, text_sha256, keep_id, group_size. rows: doc_id, key, text_sha256, chars. cells: cell, bucket, depth."""

    entries: DataFrame
    rows: DataFrame
    cells: DataFrame
    depth: int
    hash_bits: int


def normalised(text: Column) -> Column:
    return F.translate(text, BLANKS, "")


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, hash_bits: int = 64
) -> Index:
    """hash_bits below 64 makes different texts share keys, which the tests use to reach the chains."""
    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body"))
    keyed = source.select("doc_id", F.length("body").alias("chars"), normalised(F.col("body")).alias("bare")).withColumn(
        "key", F.shiftrightunsigned(F.xxhash64("bare"), 64 - hash_bits)
    )
    rows = stored(keyed.select("doc_id", "chars", "key", F.sha2(F.encode("bare", "utf-8"), 256).alias("text_sha256")), "exact-rows")

    shared = stored(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "exact-shared-keys")
    best = F.min(F.struct((-F.col("chars")).alias("minus_chars"), F.col("doc_id").isNull().alias("nameless"), "doc_id"))
    chains = (
        keyed.join(shared, "key", "left_semi")
        .groupBy("key", "bare")
        .agg(best.alias("best"), F.count("*").alias("group_size"))
        .select(
            "key",
            F.sha2(F.encode("bare", "utf-8"), 256).alias("text_sha256"),
            F.col("best.doc_id").alias("keep_id"),
            "group_size",
        )
    )
    single = rows.join(shared, "key", "left_anti").select(
        "key", "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    )
    entries = stored(chains.unionByName(single), "exact-entries")
    cells, depth = directory(entries, capacity, hash_bits)
    placed = entries.withColumn("cell", prefix("key", depth, hash_bits)).join(cells, "cell").drop("cell")
    owned = placed.repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key")
    return Index(stored(owned, "exact-index"), rows, cells, depth, hash_bits)


def prefix(key: str, depth: int, hash_bits: int) -> Column:
    """The leading ``depth`` bits of a key. (Two shifts, since a shift by 64 places would do nothing.)"""
    rest = hash_bits - depth
    return F.shiftrightunsigned(F.shiftrightunsigned(F.col(key), rest // 2), rest - rest // 2)


def directory(entries: DataFrame, capacity: int, hash_bits: int) -> tuple[DataFrame, int]:
    """The cells of the directory (cell, bucket, depth) and its depth.

    A cell is a row for each prefix of full depth in use; the bucket is named by its depth and its own, shorter prefix.
    """
    keys = stored(entries.select("key").distinct(), "exact-keys")
    depth = min(hash_bits, max(0, ceil(log2(max(1, keys.count()) / capacity))))
    while True:
        filled = keys.groupBy(prefix("key", depth, hash_bits).alias("cell")).agg(F.count("*").alias("n"))
        largest = filled.agg(F.max("n")).first()[0] or 0
        if largest <= capacity or depth == hash_bits:
            break
        depth += 1
    # How many keys share each cell's leading bits, for all numbers of bits; a row per cell and number.
    bits = F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("bits")
    leading = F.when(F.col("bits") == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftrightunsigned", F.col("cell"), (F.lit(depth) - F.col("bits")).cast("int"))
    )
    prefixes = filled.select("cell", "n", bits).withColumn("leading", leading)
    held = prefixes.groupBy("bits", "leading").agg(F.sum("n").alias("held"))
    fitting = prefixes.join(held, ["bits", "leading"]).where((F.col("held") <= capacity) | (F.col("bits") == depth))
    own = fitting.groupBy("cell").agg(F.min(F.struct("bits", "leading")).alias("own"))
    cells = own.select("cell", F.concat_ws("/", "own.bits", "own.leading").alias("bucket"), F.col("own.bits").alias("depth"))
    return stored(cells, "exact-directory"), depth


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, keep_id (longest original text, then smallest id, of its equal texts), group_size, kept, text_sha256."""
    return _looked_up(build_index(docs, id_col, text_col, **options))


def _looked_up(index: Index) -> DataFrame:
    cell = prefix("key", index.depth, index.hash_bits)
    routed = index.rows.withColumn("cell", cell).join(index.cells.select("cell", "bucket"), "cell")
    found = routed.join(index.entries, ["bucket", "key", "text_sha256"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that stay, with all their columns. Only rows whose id may be that of a row that goes are hashed again and exchanged."""
    index = build_index(docs, id_col, text_col, **options)
    found = stored(_looked_up(index), "exact-found")
    discard(index.entries, index.rows, index.cells)
    own_text = F.sha2(F.encode(normalised(text_of(text_col)), "utf-8"), 256)

    def among(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
        groups = groups.select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text"))
        return rows.join(groups, rows[id_col].eqNullSafe(groups["gone_id"]) & (own_text == groups["gone_text"]), how)

    # Rows that share both id and text are reduced to one in each task first.
    again = stored(
        found.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1"), "exact-repeated"
    )
    gone = found.where("not kept").select("doc_id", "text_sha256")
    repeated = not again.isEmpty()
    gone = stored(gone.unionByName(again.select("doc_id", "text_sha256")) if repeated else gone, "exact-gone")
    discard(found)
    stay, maybe = apart(docs, id_col, gone.select("doc_id"))
    left = stay.union(among(maybe, gone, "left_anti"))
    if not repeated:
        return left
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    longest = F.max_by(whole, F.struct(F.length(text_of(text_col)), F.xxhash64(text_of(text_col))))
    several = among(apart(docs, id_col, again.select("doc_id"))[1], again, "left_semi")
    single = several.groupBy(F.col(id_col).alias("own_id"), own_text.alias("own_text")).agg(longest.alias("row"))
    return left.unionByName(single.select("row.*"))
