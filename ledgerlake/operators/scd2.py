"""Type-2 history of a dimension."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.functions.rules import differs
from ledgerlake.schemas import HISTORY

OPEN_END = "TIMESTAMP '9999-12-31 23:59:59'"


class Step(NamedTuple):
    """Result of one load: the rows now in force and the rows it closed."""

    current: DataFrame
    closed: DataFrame


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.where("is_current")


def one_row_per_key(snapshot: DataFrame, key: str) -> DataFrame:
    """Collapse repeated keys to one row, the greatest by all attributes.

    The aggregate is partly done before its shuffle, so a key repeated many times is cheap, and
    it leaves the rows partitioned by ``key`` for the join that follows.
    """
    rest = [c for c in snapshot.columns if c != key]
    best = F.max(F.struct(*rest)).alias("_row")
    return snapshot.groupBy(key).agg(best).select(key, "_row.*")


def scd2_rows(current: DataFrame, snapshot: DataFrame, key: str, tracked, as_of: Column) -> DataFrame:
    """Current rows against the snapshot in one full outer join, each key giving its resulting rows:
    those now in force and those this snapshot closes. Older closed rows are neither read nor needed.
    """
    attributes = [c for c in snapshot.columns if c != key]
    history = HISTORY.names
    old = current.select(F.col(key).alias("_old_key"), F.struct(*attributes, *history).alias("_old"))
    new = one_row_per_key(snapshot.where(F.col(key).isNotNull()), key).select(
        F.col(key).alias("_new_key"), F.struct(*attributes).alias("_new")
    )
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    changed = differs([(F.col(f"_old.{c}"), F.col(f"_new.{c}")) for c in tracked])

    def row(side: str, start: Column, end: Column, current_flag: Column, version: Column) -> Column:
        k = F.col("_old_key") if side == "_old" else F.col("_new_key")
        return F.struct(
            k.alias(key),
            *[F.col(f"{side}.{c}").alias(c) for c in attributes],
            start.alias("effective_from"),
            end.alias("effective_to"),
            current_flag.alias("is_current"),
            version.cast("int").alias("scd_version"),
        )

    kept = row("_old", *[F.col(f"_old.{h}") for h in history])
    ended = row("_old", F.col("_old.effective_from"), as_of, F.lit(False), F.col("_old.scd_version"))
    far = F.expr(OPEN_END)
    first = row("_new", as_of, far, F.lit(True), F.lit(1))
    following = row("_new", as_of, far, F.lit(True), F.col("_old.scd_version") + 1)
    rows = (
        F.when(F.col("_old_key").isNull(), F.array(first))
        .when(F.col("_new_key").isNull(), F.array(kept))
        .when(changed, F.array(ended, following))
        .otherwise(F.array(kept))
    )
    return both.select(F.explode(rows).alias("_r")).select("_r.*")


def scd2_step(current: DataFrame, snapshot: DataFrame, key: str, tracked, as_of: Column) -> Step:
    """Advance the current rows by one snapshot. Closed history is neither read nor rewritten.

    New keys start at version 1, changed keys get the next version while the superseded row is
    closed, unchanged keys and keys missing from the snapshot stay as they are. Only a
    superseded row is closed, so each key has exactly one current row.
    """
    rows = scd2_rows(current, snapshot, key, tracked, as_of)
    return Step(rows.where("is_current"), rows.where("NOT is_current"))


def scd2_apply(dim: DataFrame, snapshot: DataFrame, key: str, tracked, as_of: Column) -> DataFrame:
    """The whole dimension after one snapshot; already closed rows pass through unjoined."""
    columns = [key, *[c for c in snapshot.columns if c != key], *HISTORY.names]
    rows = scd2_rows(current_rows(dim), snapshot, key, tracked, as_of)
    return dim.where("NOT is_current").select(*columns).unionByName(rows.select(*columns))


def changed_keys(dim: DataFrame, snapshot: DataFrame, key: str, tracked) -> DataFrame:
    """Keys whose current row differs from the snapshot, with the version they will get."""
    old = current_rows(dim).select(
        F.col(key).alias("_old_key"), "scd_version", *[F.col(c).alias(f"_old_{c}") for c in tracked]
    )
    new = one_row_per_key(snapshot, key)
    moved = old.join(new, F.col("_old_key") == F.col(key), "inner").where(
        differs([(F.col(f"_old_{c}"), F.col(c)) for c in tracked])
    )
    return moved.select(key, *tracked, (F.col("scd_version") + 1).cast("int").alias("scd_version"))


def new_keys(dim: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Snapshot rows whose key has no current row."""
    return one_row_per_key(snapshot, key).join(current_rows(dim).select(key), key, "left_anti")
