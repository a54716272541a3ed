"""The five dimensions: cleaning rules, typing, tracked attributes and load order."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlake.functions import parsing as P
from ledgerlake.functions.rules import all_of, in_domain, is_key, is_present, matches
from ledgerlake.operators.quality import Parent, RuleSet, Split, dq_flag, dq_parts, dq_split
from ledgerlake.operators.scd2 import scd2_apply, scd2_rows
from ledgerlake.schemas import GOLD_DIMENSIONS, SILVER
from ledgerlake.sinks import write_history_load
from ledgerlake.sources.tables import read_history

c = F.col

# The two kinds of disposition.
DISP_TYPES = ("OWNER", "DISPONENT")


@dataclass(frozen=True)
class Dimension:
    name: str
    # Functions, because column expressions need a running session.
    rules: Callable[[], RuleSet]
    typed: Callable[[], tuple[Column, ...]]
    after: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return SILVER[self.name].names[0]

    @property
    def tracked(self) -> list[str]:
        return SILVER[self.name].names[1:]


# Reject reasons and column types per dimension.
_DISTRICT_TYPES = dict(
    [(f"A{i}", P.to_whole) for i in range(4, 10)]
    + [("A10", P.to_double), ("A11", P.to_whole), ("A12", P.to_double), ("A13", P.to_double)]
    + [(f"A{i}", P.to_whole) for i in range(14, 17)]
)

DIMENSIONS = {
    d.name: d
    for d in (
        Dimension(
            "district",
            rules=lambda: RuleSet(
                required=(is_key(c("A1")), is_present(c("A2")), is_present(c("A3"))),
                reason="Invalid district id or missing name/region",
            ),
            typed=lambda: (
                P.to_long(c("A1")).alias("district_id"),
                c("A2").alias("district_name"),
                c("A3").alias("region"),
                *[parse(c(name)).alias(name) for name, parse in _DISTRICT_TYPES.items()],
            ),
        ),
        Dimension(
            "client",
            rules=lambda: RuleSet(
                required=(is_key(c("client_id")), is_key(c("district_id")), is_present(c("birth_number"))),
                parents=(Parent("district", "district_id", P.to_long(c("district_id"))),),
                reason="Invalid client_id/district_id format, missing birth_number, or unknown district_id",
            ),
            typed=lambda: (
                P.to_long(c("client_id")).alias("client_id"),
                c("birth_number"),
                P.to_long(c("district_id")).alias("district_id"),
            ),
            after=("district",),
        ),
        Dimension(
            "account",
            rules=lambda: RuleSet(
                required=(is_key(c("account_id")), is_key(c("district_id")), is_present(c("frequency"))),
                advisory=(is_present(c("created_date")),),
                reason="Invalid account/district identifiers, frequency, or created_date",
            ),
            typed=lambda: (
                P.to_long(c("account_id")).alias("account_id"),
                P.to_long(c("district_id")).alias("district_id"),
                c("frequency"),
                P.compact_date(c("created_date")).alias("open_date"),
            ),
            after=("district",),
        ),
        Dimension(
            "disp",
            rules=lambda: RuleSet(
                required=(
                    is_key(c("disp_id")),
                    is_key(c("client_id")),
                    is_key(c("account_id")),
                    in_domain(c("type"), DISP_TYPES),
                ),
                reason="Invalid disposition identifiers or type",
            ),
            typed=lambda: (
                P.to_long(c("disp_id")).alias("disp_id"),
                P.to_long(c("client_id")).alias("client_id"),
                P.to_long(c("account_id")).alias("account_id"),
                c("type").alias("disp_type"),
            ),
            after=("client", "account"),
        ),
        Dimension(
            "card",
            rules=lambda: RuleSet(
                required=(is_key(c("card_id")), is_key(c("disp_id")), is_present(c("type"))),
                advisory=(is_present(c("issued")),),
                reason="Invalid card/disp identifiers, type, or issued",
            ),
            typed=lambda: (
                P.to_long(c("card_id")).alias("card_id"),
                P.to_long(c("disp_id")).alias("disp_id"),
                c("type").alias("card_type"),
                P.compact_timestamp(c("issued")).alias("issued_at"),
            ),
            after=("disp",),
        ),
    )
}


def eligible_accounts(raw: DataFrame) -> DataFrame:
    """Raw accounts that satisfy every rule and carry a six-digit date."""
    dated = matches(c("created_date"), P.SIX_DIGITS)
    return raw.where(all_of([*DIMENSIONS["account"].rules().required, dated]))


def split(
    name: str,
    bronze: DataFrame,
    run_date: Column | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    strict: bool = False,
) -> Split:
    """Accepted, rejected and warned raw rows of one dimension."""
    date = F.current_date() if run_date is None else run_date
    return dq_split(bronze, DIMENSIONS[name].rules(), date, parents, strict)


def flag(
    name: str, bronze: DataFrame, parents: Mapping[str, DataFrame] | None = None, strict: bool = False
) -> DataFrame:
    """Raw rows with the outcome of their rules; stored, they give every part without another look at the parents."""
    return dq_flag(bronze, DIMENSIONS[name].rules(), parents, strict)


def parts(name: str, flagged: DataFrame, run_date: Column | None = None) -> Split:
    return dq_parts(flagged, DIMENSIONS[name].rules().reason, F.current_date() if run_date is None else run_date)


def silver(name: str, accepted: DataFrame) -> DataFrame:
    """Typed business columns of accepted raw rows."""
    return accepted.select(*DIMENSIONS[name].typed())


def empty_dimension(spark, name: str) -> DataFrame:
    return spark.createDataFrame([], GOLD_DIMENSIONS[f"dim_{name}"])


def gold(name: str, current: DataFrame | None, snapshot: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The dimension's history after loading one silver snapshot."""
    d = DIMENSIONS[name]
    when = F.current_timestamp() if as_of is None else as_of
    before = empty_dimension(snapshot.sparkSession, name) if current is None else current
    return scd2_apply(before, snapshot, d.key, d.tracked, when)


def advance(spark: SparkSession, base: str, name: str, snapshot: DataFrame, as_of: Column | None = None) -> str:
    """Load one silver snapshot into the history stored below ``base``."""
    d = DIMENSIONS[name]
    when = F.current_timestamp() if as_of is None else as_of
    current = read_history(spark, base, GOLD_DIMENSIONS[f"dim_{name}"], current_only=True)
    before = empty_dimension(spark, name) if current is None else current
    return write_history_load(scd2_rows(before, snapshot, d.key, d.tracked, when), base)


@dataclass(frozen=True)
class DimensionRun:
    silver: dict[str, DataFrame]
    rejected: dict[str, DataFrame]
    warned: dict[str, DataFrame]
    gold: dict[str, DataFrame]


def load_order() -> list[str]:
    """Dimension names, each after those it depends on."""
    done: list[str] = []
    while len(done) < len(DIMENSIONS):
        ready = [n for n, d in DIMENSIONS.items() if n not in done and set(d.after) <= set(done)]
        done.extend(ready)
    return done


def run_dimensions(
    bronze: Mapping[str, DataFrame],
    current: Mapping[str, DataFrame] | None = None,
    run_date: Column | None = None,
    as_of: Column | None = None,
    strict: bool = False,
) -> DimensionRun:
    """Raw tables to silver, rejects and the next state of every history, in dependency order."""
    run = DimensionRun({}, {}, {}, {})
    for name in load_order():
        found = split(name, bronze[name], run_date, run.silver, strict)
        run.silver[name] = silver(name, found.accepted)
        run.rejected[name], run.warned[name] = found.rejected, found.warned
        run.gold[name] = gold(name, (current or {}).get(name), run.silver[name], as_of)
    return run
