"""Latest activity per client: one shape per event kind, merged into one row per client."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerlake.functions.parsing import iso_timestamp, pad_to
from ledgerlake.operators.combine import left_current, lookup, stack
from ledgerlake.operators.windows import latest
from ledgerlake.schemas import CLIENT_SCORES, CUSTOMER_360
from ledgerlake.sources.events import parse_events


@dataclass(frozen=True)
class Shape:
    """How the latest event of a kind appears in the record: event column -> record column."""

    id: str
    ts: str
    cells: dict[str, str]


SHAPES = {
    "loan": Shape(
        "loan_id",
        "last_loan_ts",
        {"loan_id": "loan_id", "amount": "last_loan_amount", "status": "last_loan_status"},
    ),
    "order": Shape(
        "order_id",
        "last_order_ts",
        {"order_id": "last_order_id", "amount": "last_order_amount", "k_symbol": "last_order_k_symbol"},
    ),
    "trans": Shape(
        "trans_id",
        "last_trans_ts",
        {
            "trans_id": "last_trans_id",
            "amount": "last_trans_amount",
            "type": "last_trans_type",
            "operation": "last_trans_operation",
        },
    ),
}


def activity(envelopes: DataFrame, kind: str) -> DataFrame:
    """The event columns a shape needs, for events with an id and a client."""
    shape = SHAPES[kind]
    return (
        parse_events(envelopes, kind, "client_id", "account_id", *shape.cells, "ingest_ts")
        .where(F.col(shape.id).isNotNull() & F.col("client_id").isNotNull())
        .select("client_id", "account_id", *shape.cells, iso_timestamp(F.col("ingest_ts")).alias("ingest_ts"))
    )


def latest_activity(events: DataFrame, kind: str) -> DataFrame:
    """The latest event of each client; ties in time go to the greater id, then to the greater values."""
    spec = SHAPES[kind]
    return latest(events, "client_id", "ingest_ts", spec.id, *[x for x in spec.cells if x != spec.id])


def owned_scores(scores: DataFrame, loans: DataFrame) -> DataFrame:
    """Each prediction with the client it is about: client_id, loan_id, pred_status, score_timestamp."""
    owned = scores.select("loan_id", "pred_status", "score_timestamp").join(
        loans.select("loan_id", "client_id").where("client_id IS NOT NULL"), "loan_id", "inner"
    )
    return owned.select(*CLIENT_SCORES.names)


def newest_scores(owned: DataFrame) -> DataFrame:
    """One row per client of ``owned_scores``; may be merged with the result of earlier runs."""
    return latest(owned, "client_id", "score_timestamp", "loan_id")


def latest_scores(scores: DataFrame, loans: DataFrame) -> DataFrame:
    """The newest prediction per client: client_id, pred_status, score_timestamp."""
    return newest_scores(owned_scores(scores, loans)).select("client_id", "pred_status", "score_timestamp")


def shape(
    events: DataFrame, kind: str, clients: DataFrame, accounts: DataFrame, scores: DataFrame | None = None
) -> DataFrame:
    """One full-width record per client with activity of this kind.

    ``events`` come from ``activity``; ``scores`` from ``latest_scores`` and may be missing.
    Columns of the other kinds are NULL. The client keeps the id its event carries, so an
    unknown client still has a key.
    """
    spec = SHAPES[kind]
    last = latest_activity(events, kind).select(
        "client_id",
        F.col("account_id").alias("_account"),
        *[F.col(e).alias(r) for e, r in spec.cells.items()],
        F.col("ingest_ts").alias(spec.ts),
    )
    if kind == "loan" and scores is not None:
        last = lookup(
            last, scores, "client_id",
            last_default_pred_status="pred_status", last_default_score_ts="score_timestamp",
        )
    last = left_current(
        last, clients, "client_id",
        birth_number="birth_number", client_district_id="district_id", _known="client_id",
    )
    last = left_current(
        last, accounts, "_account", dim_key="account_id",
        account_id="account_id", account_district_id="district_id",
    )
    found = {"client_ts": "_known", "account_ts": "account_id"}
    looked_up = {name: F.when(F.col(by).isNotNull(), F.col(spec.ts)) for name, by in found.items()}
    return pad_to(last.withColumns(looked_up), CUSTOMER_360)


def merge(records: DataFrame) -> DataFrame:
    """One row per client from any number of records, in any order.

    Each cell takes the newest value that is not NULL, so a record without orders leaves the
    order cells alone. Equal times are settled by id and value. The result can be merged again.
    An id is never NULL where its time is set, so one aggregate gives both.
    """
    col = F.col

    def rank(column: str, *order: str):
        return F.max(F.when(col(column).isNotNull(), F.struct(*[col(o) for o in order], col(column))))

    by = {
        "birth_number": ["client_ts"],
        "client_district_id": ["client_ts"],
        "account_district_id": ["account_ts", "account_id"],
        "last_loan_amount": ["last_loan_ts", "loan_id"],
        "last_loan_status": ["last_loan_ts", "loan_id"],
        "last_default_pred_status": ["last_default_score_ts"],
        "last_order_amount": ["last_order_ts", "last_order_id"],
        "last_order_k_symbol": ["last_order_ts", "last_order_id"],
        "last_trans_amount": ["last_trans_ts", "last_trans_id"],
        "last_trans_type": ["last_trans_ts", "last_trans_id"],
        "last_trans_operation": ["last_trans_ts", "last_trans_id"],
    }
    ids = {
        "account_ts": "account_id", "last_loan_ts": "loan_id", "last_order_ts": "last_order_id",
        "last_trans_ts": "last_trans_id",
    }
    cells = [rank(name, *order).getField(name).alias(name) for name, order in by.items()]
    pairs = [rank(name, at).alias(f"_{name}") for at, name in ids.items()]
    return (
        records.where(col("client_id").isNotNull())
        .groupBy("client_id")
        .agg(*cells, *pairs, *[F.max(t).alias(t) for t in ("client_ts", "last_default_score_ts")])
        .select("*", *[f"_{name}.*" for name in ids.values()])
        .select(*CUSTOMER_360.names)
    )


def merge_latest(current: DataFrame, updates: DataFrame) -> DataFrame:
    """Upsert ``updates`` into ``current``; both hold records as ``shape`` or ``merge`` give them."""
    return merge(stack([current, updates]))


def point_lookup(records: DataFrame, client_id: int) -> DataFrame:
    """The record of one client, or no row."""
    return records.where(F.col("client_id") == client_id)
