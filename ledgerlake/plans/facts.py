"""Event facts: decode, type, validate, and add the account's current district."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ledgerlake.functions.money import money
from ledgerlake.functions.parsing import iso_timestamp
from ledgerlake.functions.rules import holds
from ledgerlake.operators.combine import left_current
from ledgerlake.schemas import EVENTS, GOLD_FACTS, SILVER_FACTS
from ledgerlake.sources.events import parse_events


@dataclass(frozen=True)
class Fact:
    """Id column, SQL condition for the sign of an amount, and columns typed or renamed in SQL."""

    id: str
    valid_amount: str
    derived: dict[str, str]


FACTS = {
    "loan": Fact("loan_id", "amount > 0", {"loan_date": "try_cast(date AS DATE)"}),
    "order": Fact("order_id", "amount > 0", {}),
    "trans": Fact("trans_id", "amount <> 0", {"trans_date": "try_cast(date AS DATE)", "trans_type": "type"}),
}


REJECT_REASON = "Malformed event, missing id, or amount missing, out of range or of the wrong sign"


def is_valid(kind: str) -> Column:
    """An event has an id and an amount that marts can add up: neither NULL nor NaN, and not too large for money."""
    fact = FACTS[kind]
    return holds(F.col(fact.id).isNotNull() & money(F.col("amount")).isNotNull() & F.expr(fact.valid_amount))


def valid_events(events: DataFrame, kind: str) -> DataFrame:
    return events.where(is_valid(kind))


def rejected_events(envelopes: DataFrame, kind: str) -> DataFrame:
    """The documents that ``valid_events`` leaves out, as text, with the reason. Only the fields that decide are decoded."""
    deciding = StructType([EVENTS[kind][name] for name in (FACTS[kind].id, "amount")])
    text = F.col("value").cast("string")
    fields = F.inline(F.array(F.struct(text.alias("document"), F.from_json(text, deciding).alias("e"))))
    rows = envelopes.select(fields).select("document", "e.*")
    return rows.where(~is_valid(kind)).select("document", F.lit(REJECT_REASON).alias("dq_reason"))


def drifted_fields(envelopes: DataFrame, kind: str) -> DataFrame:
    """What silver facts have no place for: (event_id, field, known, value), a row per field of a valid event that is unknown, or of another type
    than its column and so NULL there.

    ``value`` is a VARIANT, whatever the producer sent, so a new field is not lost and can be typed once its type is settled. Fields without a
    value give no row; of a field that a document repeats the last counts, as in the facts. Rejected events are kept whole elsewhere.
    """
    schema, text = EVENTS[kind], F.col("value").cast("string")
    both = F.struct(F.from_json(text, schema).alias("e"), F.from_json(text, "MAP<STRING, VARIANT>").alias("_sent"))
    events = valid_events(envelopes.select(F.inline(F.array(both))).select("e.*", "_sent"), kind)
    names = F.map_keys("_sent")
    known = F.array(*[F.lit(n) for n in schema.names])
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in schema.names]))

    def drifted(field: Column, i: Column) -> Column:
        last = F.array_position(F.reverse(names), field["key"]) == F.size(names) - i
        lost = ~F.array_contains(known, field["key"]) | F.array_contains(missing, field["key"])
        return last & lost & ~F.is_variant_null(field["value"])

    fields = F.inline(F.filter(F.map_entries("_sent"), drifted)).alias("field", "value")
    rows = events.select(F.col(FACTS[kind].id).alias("event_id"), fields)
    return rows.select("event_id", "field", F.col("field").isin(schema.names).alias("known"), "value")


def with_drifted(facts: DataFrame, drift: DataFrame, kind: str, field: str, data_type: str, path: str = "$") -> DataFrame:
    """Stored facts with one more column: a field that was unknown when they came, typed now (NULL where it does not fit). ``path`` goes into it."""
    keys = ["event_id", "stream_id", "batch_id"]
    typed = drift.where(F.col("field") == field).select(*keys, F.try_variant_get("value", path, data_type).alias("_typed"))
    # An event may have come twice in a batch.
    once = typed.groupBy(*keys).agg(F.max("_typed").alias("_typed"))
    same = [facts[FACTS[kind].id] == once["event_id"], *[facts[k] == once[k] for k in keys[1:]]]
    return facts.join(once, same, "left").select(facts["*"], once["_typed"].alias(field))


def silver_fact(envelopes: DataFrame, kind: str, batch_id: int) -> DataFrame:
    """Typed, valid facts of one batch of envelopes."""
    typed = valid_events(parse_events(envelopes, kind), kind).withColumns(
        {
            **{name: F.expr(sql) for name, sql in FACTS[kind].derived.items()},
            "ingest_ts": iso_timestamp(F.col("ingest_ts")),
            "batch_id": F.lit(batch_id).cast("bigint"),
        }
    )
    return typed.select(*SILVER_FACTS[f"fact_{kind}"].names)


def gold_fact(silver: DataFrame, accounts: DataFrame, kind: str) -> DataFrame:
    """Facts with the district their account belongs to now; NULL for an unknown account."""
    enriched = left_current(silver, accounts, "account_id", account_dim_district_id="district_id")
    return enriched.select(*GOLD_FACTS[f"fact_{kind}"].names)


def fact_batch(
    envelopes: DataFrame, accounts: DataFrame, kind: str, batch_id: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(silver, gold) of one batch."""
    silver = silver_fact(envelopes, kind, batch_id)
    return silver, gold_fact(silver, accounts, kind)
