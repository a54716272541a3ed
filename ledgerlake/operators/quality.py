"""Split raw rows into accepted and rejected ones by declared rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ledgerlake.functions.rules import all_of, holds


@dataclass(frozen=True)
class Parent:
    """The row's ``key`` (an expression over the raw row) must occur in ``table.column``."""

    table: str
    column: str
    key: Column


@dataclass(frozen=True)
class RuleSet:
    required: tuple[Column, ...]
    reason: str
    advisory: tuple[Column, ...] = ()
    parents: tuple[Parent, ...] = field(default=())


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame
    warned: DataFrame


def has_parent(df: DataFrame, parents: DataFrame, column: str, key: Column, flag: str) -> DataFrame:
    """Add ``flag``: true when ``key`` occurs in ``parents.column``, else false.

    The parent side is reduced to distinct keys, so the join keeps the row count. Spark
    broadcasts it if its measured size allows and otherwise splits skewed keys at run time.
    """
    keys = parents.select(F.col(column).alias(f"{flag}_key")).distinct().withColumn(flag, F.lit(True))
    marked = df.join(keys, key == F.col(f"{flag}_key"), "left").drop(f"{flag}_key")
    return marked.withColumn(flag, F.coalesce(flag, F.lit(False)))


def dq_flag(
    df: DataFrame, rules: RuleSet, parents: Mapping[str, DataFrame] | None = None, strict: bool = False
) -> DataFrame:
    """Add ``_ok``, whether a row keeps all rules, and ``_advised``, whether it keeps the advisory ones too.

    ``strict`` makes the advisory rules binding.
    """
    columns = df.columns
    flags = []
    checked = df
    for i, parent in enumerate(rules.parents):
        flag = f"_parent_{i}"
        checked = has_parent(checked, parents[parent.table], parent.column, parent.key, flag)
        flags.append(F.col(flag))
    required = list(rules.required) + flags + (list(rules.advisory) if strict else [])
    advised = holds(all_of(rules.advisory)) if rules.advisory else F.lit(True)
    return checked.select(*columns, holds(all_of(required)).alias("_ok"), advised.alias("_advised"))


def dq_parts(flagged: DataFrame, reason: str, run_date: Column) -> Split:
    """The parts of rows that ``dq_flag`` has marked."""
    columns = flagged.columns[:-2]

    def reported(rows: DataFrame) -> DataFrame:
        return rows.select(*columns, run_date.alias("dq_date"), F.lit(reason).alias("dq_reason"))

    return Split(
        flagged.where("_ok").select(*columns),
        reported(flagged.where("NOT _ok")),
        reported(flagged.where("_ok AND NOT _advised")),
    )


def dq_split(
    df: DataFrame,
    rules: RuleSet,
    run_date: Column,
    parents: Mapping[str, DataFrame] | None = None,
    strict: bool = False,
) -> Split:
    """Every input row is either accepted or rejected, rows with NULLs included.

    ``warned`` lists accepted rows that break an advisory rule; ``strict`` rejects them.
    Rejected and warned rows keep their original strings, with the date and the reason.
    """
    return dq_parts(dq_flag(df, rules, parents, strict), rules.reason, run_date)


def expectations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(expectation, checked, failed) for each named rule, from one pass; an unknown answer fails."""
    outcomes = F.array(
        *[F.struct(F.lit(n).alias("expectation"), holds(rule).alias("met")) for n, rule in rules.items()]
    )
    return (
        df.select(F.explode(outcomes).alias("o"))
        .groupBy("o.expectation")
        .agg(F.count("*").alias("checked"), F.count(F.when(~F.col("o.met"), 1)).alias("failed"))
    )


def measured(flagged: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows that ``dq_flag`` has marked, and how many are accepted, rejected and warned of, known once the rows are written."""
    seen = Observation()
    ok, advised = F.col("_ok"), F.col("_advised")
    counted = {"accepted": ok, "rejected": ~ok, "warned": ok & ~advised}
    return flagged.observe(seen, *[F.count_if(rule).alias(name) for name, rule in counted.items()]), seen


class Measured:
    """Named rules counted while rows are written: no second pass over them."""

    def __init__(self, df: DataFrame, rules: Mapping[str, Column]):
        self._names, self._seen = list(rules), Observation()
        failed = [F.count_if(~holds(rule)).alias(f"failed_{i}") for i, rule in enumerate(rules.values())]
        self.rows = df.observe(self._seen, F.count("*").alias("checked"), *failed)

    def expectations(self, spark: SparkSession) -> DataFrame:
        """(expectation, checked, failed) as ``expectations`` gives it, after the rows were written."""
        found = self._seen.get
        rows = [(name, found["checked"], found[f"failed_{i}"]) for i, name in enumerate(self._names)]
        return spark.createDataFrame(rows, "expectation STRING, checked BIGINT, failed BIGINT")
