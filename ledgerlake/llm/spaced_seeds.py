"""Benchmark passages in documents, by spaced-seed hashing. DataFrame operations only.

A mask such as ``111000111`` hashes the words at its ones and ignores those at its zeros, so a passage in which some words were replaced
still agrees with its benchmark item under some mask at some position.

1. Each benchmark item is split into words (maximal runs other than blanks, A-Z folded), and hashed at all positions of the masks that
   its length needs (``masks``). These are chosen so that every overlap that step 3 confirms leaves a hit: cut into blocks of three (short
   items: two) words, a passage keeps two whole blocks near each other, whichever words were replaced, and a mask holds two blocks.
   Passages of five words keep four.
2. Each document's words are hashed once. A position is looked at further only where its first words, up to ``LEAD``, hash to a bit that some seed's first
   words set in a bitmap (of a size fixed by the number of seeds, at most ``BITMAP`` longs); there the masked seeds are hashed and joined to the
   benchmark's. Up to ``BROADCAST_SEEDS`` seeds (a count taken first) go to the documents; a larger benchmark is joined by a shuffle. A hit
   names the item and the place at which it would begin.
3. At that place the item's words are compared with the document's words themselves. An overlap is confirmed where at least
   ``share`` per cent of the item's words stand at their places, or as many of some ``window`` successive ones.

Items of one to four words are found where all their words stand in a row. Null or empty texts match nothing, nor do items without words. Rows repeated in
either table give each finding once. Columns other than id and text are not looked at; a document with a null id gives a finding with a null
id. Empty tables give no finding.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.llm.common import BLANKS, stored, text_of

# Of five words with one replaced, one of these keeps its ones.
MASKS = ("11110", "01111", "11101", "11011", "10111")
SPAN = len(MASKS[0])  # all of these have it
WIDTHS = (3, 2, 1)  # words of a block, the first that fits
SHARE = 80  # per cent
WINDOW = 15  # words
MIN_WORDS = 1
LEAD = 3  # words
BITMAP = 1 << 17  # longs
BROADCAST_SEEDS = 2_000_000  # two numbers each

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded_words(text: str) -> Column:
    """The words of a text, A-Z folded to a-z."""
    even = F.trim(F.translate(F.col(text), UPPER + BLANKS, UPPER.lower() + " " * len(BLANKS)))
    return F.array_remove(F.split(even, " +"), "")


Mask = tuple[tuple[int, int], ...]  # its runs of ones: first word, words


def _runs(mask: str) -> Mask:
    return tuple((m.start(), len(m[0])) for m in re.finditer("1+", mask.strip("0")))


def _covering(length: int, replaced: int) -> set[Mask]:
    """Masks of which one hits any passage of so many words with so many of them replaced."""
    if not replaced and length < SPAN:
        return {((0, length),)}
    if SPAN <= length < 2 * SPAN and replaced <= 1 and length // 2 < replaced + 2:
        return {_runs(mask) for mask in MASKS}
    for width in WIDTHS:
        blocks = length // width
        if blocks >= replaced + 2:
            # Blocks that are whole stand more than this many blocks apart only if fewer are whole than must be.
            far = next(far for far in range(1, blocks) if -(-blocks // (far + 1)) < blocks - replaced)
            return {((0, 2 * width),) if k == 1 else ((0, width), (k * width, width)) for k in range(1, far + 1)}
    return {((0, 1),)} if replaced < length else set()


def masks(length: int, share: int = SHARE, window: int = WINDOW) -> set[Mask]:
    """The masks that leave no overlap of an item of so many words unseen."""
    replaced = lambda n: n * (100 - share) // 100
    return _covering(length, replaced(length)) | (_covering(window, replaced(window)) if length >= window else set())


def _lead(mask: Mask) -> int:
    return min(mask[0][1], LEAD)


def _cell(x: Column, longs: int) -> Column:
    """Which of so many longs, a power of two, holds this hash's bit."""
    return F.shiftrightunsigned(x, 64 - (longs.bit_length() - 1)).cast("int") if longs > 1 else F.lit(0)


def _first_words(i: Column, width: int) -> Column:
    """The hash of this many words from position i on; beyond the last word it means nothing."""
    return F.xxhash64(*[F.get(F.col("h"), i + k) for k in range(width)])


def _seeds(words: DataFrame, key: str, wanted: list[Mask], leads: dict[int, list[int]] | None = None) -> DataFrame:
    """key, at (position in words), lead, first (the hash of the first ``lead`` words), seed; from a table of key and h, the hashes of its words.

    ``leads`` names, by a number of words, the longs of a bitmap; positions whose first words it lacks are left out.
    """

    def looked_up(longs: list[int], x: Column) -> Column:
        # One literal, which is folded to an array when the plan is optimised.
        bitmap = F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")
        return F.call_function("getbit", F.get(bitmap, _cell(x, len(longs))), x.bitwiseAND(F.lit(63)).cast("int")) == 1

    def places(width: int) -> Column:
        count = F.size("h") - width + 1
        every = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
        if leads is None:
            return every
        first = F.transform(every, lambda i: _first_words(i, width))
        return F.filter(F.transform(first, lambda x, i: F.when(looked_up(leads[width], x), i)), lambda i: i.isNotNull())

    def under(mask: Mask) -> Column:
        width, span = _lead(mask), mask[-1][0] + mask[-1][1]

        def seed(i: Column) -> Column:
            runs = [F.xxhash64(*[F.col("h")[i + k + j] for j in range(size)]) for k, size in mask]
            return F.struct(
                i.alias("at"), F.lit(width).alias("lead"), _first_words(i, width).alias("first"), F.xxhash64(F.lit(str(mask)), *runs).alias("seed")
            )

        return F.transform(F.filter(F.col(f"at_{width}"), lambda i: i + span <= F.size("h")), seed)

    widths = sorted({_lead(mask) for mask in wanted})
    none = F.array().cast("array<struct<at:int,lead:int,first:bigint,seed:bigint>>")
    placed = words.select(key, "h", *[places(width).alias(f"at_{width}") for width in widths])
    return placed.select(key, F.inline(F.concat(none, *[under(mask) for mask in wanted])))


def _bitmaps(seeds: DataFrame) -> dict[int, list[int]]:
    """By lead the longs in which the seeds' first words have set bits; some 64 bits for each, up to a fixed size."""
    out = {}
    for lead, n in seeds.groupBy("lead").agg(F.count_distinct("first")).collect():
        longs = min(1 << max(n - 1, 1).bit_length(), BITMAP)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("first").bitwiseAND(F.lit(63)).cast("int"))
        found = seeds.where(F.col("lead") == lead).groupBy(_cell(F.col("first"), longs).alias("cell")).agg(F.bit_or(bit).alias("bits"))
        out[lead] = [0] * longs
        for at, bits in found.collect():  # at most BITMAP rows
            out[lead][at] = bits
    return out


def findings(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    share: int = SHARE,
    window: int = WINDOW,
) -> DataFrame:
    """Confirmed overlaps: doc_id, item_id, starts_at (word of the document at which the item begins), item_length, matched, best_window."""
    hashes = F.transform("all_words", lambda w: F.xxhash64(w)).alias("h")
    base = items.select(F.col(item_id_col).alias("item_id"), text_of(item_text_col).alias("body"))
    base = base.select("item_id", folded_words("body").alias("all_words")).where(F.size("all_words") >= MIN_WORDS).distinct()
    base = stored(base.select("item_id", F.col("all_words").alias("item_words"), hashes), "benchmark-words")
    # A number for each length in use: as many as the longest item has words at most.
    needed = {r[0]: masks(r[0], share, window) for r in base.select(F.size("h")).distinct().collect()}
    groups: dict[frozenset[Mask], list[int]] = {}
    for length, those in needed.items():
        groups.setdefault(frozenset(those), []).append(length)
    seeds = _seeds(base.where("false"), "item_id", [])
    for those, lengths in groups.items():
        seeds = seeds.union(_seeds(base.where(F.size("h").isin(lengths)), "item_id", sorted(those)))
    seeds = stored(seeds.distinct(), "benchmark-seeds")
    leads = _bitmaps(seeds)

    source = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("body"))
    hashed = source.select("doc_id", folded_words("body").alias("all_words")).select("doc_id", hashes)
    wanted = seeds.select("seed", "item_id", F.col("at").alias("item_at"))
    if seeds.count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    hits = _seeds(hashed, "doc_id", sorted(set().union(*groups)), leads).join(wanted, "seed")
    places = stored(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("starts_at")).distinct(), "benchmark-hits")

    involved = stored(places.select("doc_id").distinct(), "benchmark-involved")
    texts = source.join(involved, source["doc_id"].eqNullSafe(involved["doc_id"]), "left_semi").select(
        F.col("doc_id").alias("text_id"), folded_words("body").alias("doc_words")
    )
    known = base.select(F.col("item_id").alias("known_id"), "item_words")
    placed = places.join(known, F.col("item_id").eqNullSafe(F.col("known_id")))
    # Words of the item before the document's first word have no counterpart.
    lead, skip = F.greatest(-F.col("starts_at"), F.lit(0)), F.greatest(F.col("starts_at"), F.lit(0))
    rest = F.greatest(F.size("item_words") - lead, F.lit(0))
    aligned = placed.join(texts, F.col("doc_id").eqNullSafe(F.col("text_id"))).select(
        "doc_id",
        "item_id",
        "starts_at",
        F.size("item_words").alias("item_length"),
        F.concat(
            F.array_repeat(F.lit(0), lead.cast("int")),
            F.zip_with(
                F.slice("item_words", lead + 1, rest),
                F.slice("doc_words", skip + 1, rest),
                lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0)),
            ),
        ).alias("same"),
    )
    last = F.size("same") - window
    add = lambda bits: F.aggregate(bits, F.lit(0), lambda s, b: s + b)
    sliding = F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: add(F.slice("same", i + 1, window))))
    counted = aligned.select(
        "doc_id",
        "item_id",
        "starts_at",
        "item_length",
        add(F.col("same")).alias("matched"),
        F.coalesce(F.array_max(sliding), F.lit(0)).alias("best_window"),
    )
    enough = (F.col("matched") * 100 >= F.col("item_length") * share) | (F.col("best_window") * 100 >= window * share)
    return counted.where(enough).distinct()


def without_benchmark(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no benchmark passage, with all their columns."""
    found = findings(docs, items, id_col, text_col, **options)
    gone = stored(found.select(F.col("doc_id").alias("gone_id")).distinct(), "benchmark-gone")
    return docs.join(gone, docs[id_col].eqNullSafe(gone["gone_id"]), "left_anti")
