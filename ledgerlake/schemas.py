"""Declared schemas of every layer. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "BINARY": T.BinaryType(),
}


def struct(columns: str) -> T.StructType:
    """A schema from ``name TYPE, ...``, without needing a session at import time."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# File columns, in file order.
BRONZE = {
    "district": _strings(*[f"A{i}" for i in range(1, 17)]),
    "client": _strings("client_id", "birth_number", "district_id"),
    "account": _strings("account_id", "district_id", "frequency", "created_date"),
    "disp": _strings("disp_id", "client_id", "account_id", "type"),
    "card": _strings("card_id", "disp_id", "type", "issued"),
    "loan": _strings("loan_id", "account_id", "date", "amount", "duration", "payments", "status"),
    "order": _strings("order_id", "account_id", "bank_to", "account_to", "amount", "k_symbol"),
    "trans": _strings(
        "trans_id", "account_id", "trans_date", "type", "operation",
        "amount", "balance", "k_symbol", "bank", "account",
    ),
}

# Table columns, in table order.
SILVER = {
    "district": struct(
        "district_id BIGINT, district_name STRING, region STRING, A4 INT, A5 INT, A6 INT, A7 INT, A8 INT, "
        "A9 INT, A10 DOUBLE, A11 INT, A12 DOUBLE, A13 DOUBLE, A14 INT, A15 INT, A16 INT"
    ),
    "client": struct("client_id BIGINT, birth_number STRING, district_id BIGINT"),
    "account": struct("account_id BIGINT, district_id BIGINT, frequency STRING, open_date DATE"),
    "disp": struct("disp_id BIGINT, client_id BIGINT, account_id BIGINT, disp_type STRING"),
    "card": struct("card_id BIGINT, disp_id BIGINT, card_type STRING, issued_at TIMESTAMP"),
}

# The columns of a history.
HISTORY = struct("effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, scd_version INT")

GOLD_DIMENSIONS = {f"dim_{name}": T.StructType(s.fields + HISTORY.fields) for name, s in SILVER.items()}

REJECT_TAIL = struct("dq_date DATE, dq_reason STRING")

# The JSON body of each event kind.
EVENTS = {
    "loan": struct(
        "loan_id BIGINT, account_id BIGINT, district_id BIGINT, client_id BIGINT, disp_id BIGINT, "
        "date STRING, amount DOUBLE, duration INT, payments DOUBLE, status STRING, ingest_ts STRING"
    ),
    "order": struct(
        "order_id BIGINT, account_id BIGINT, district_id BIGINT, client_id BIGINT, disp_id BIGINT, "
        "bank_to STRING, account_to STRING, amount DOUBLE, k_symbol STRING, ingest_ts STRING"
    ),
    "trans": struct(
        "trans_id BIGINT, account_id BIGINT, district_id BIGINT, client_id BIGINT, disp_id BIGINT, "
        "date STRING, type STRING, operation STRING, amount DOUBLE, balance DOUBLE, "
        "k_symbol STRING, bank STRING, account STRING, ingest_ts STRING"
    ),
}

_PARTIES = "account_id BIGINT, client_id BIGINT, disp_id BIGINT, district_id BIGINT"

# Table columns, in table order.
SILVER_FACTS = {
    "fact_loan": struct(
        f"loan_id BIGINT, {_PARTIES}, loan_date DATE, amount DOUBLE, duration INT, payments DOUBLE, "
        "status STRING, ingest_ts TIMESTAMP, batch_id BIGINT"
    ),
    "fact_order": struct(
        f"order_id BIGINT, {_PARTIES}, bank_to STRING, account_to STRING, amount DOUBLE, k_symbol STRING, "
        "ingest_ts TIMESTAMP, batch_id BIGINT"
    ),
    "fact_trans": struct(
        f"trans_id BIGINT, {_PARTIES}, trans_date DATE, trans_type STRING, operation STRING, amount DOUBLE, "
        "balance DOUBLE, k_symbol STRING, bank STRING, account STRING, ingest_ts TIMESTAMP, batch_id BIGINT"
    ),
}


def _with_dim_district(schema: T.StructType) -> T.StructType:
    head = schema.fields[:-2]
    return T.StructType(head + [T.StructField("account_dim_district_id", T.LongType())] + schema.fields[-2:])


GOLD_FACTS = {name: _with_dim_district(s) for name, s in SILVER_FACTS.items()}

GOLD = {**GOLD_DIMENSIONS, **GOLD_FACTS}

LOAN_SCORES = struct(
    "loan_id BIGINT, score_timestamp TIMESTAMP, run_id STRING, actual_status STRING, pred_status STRING, "
    "probabilities_json STRING"
)

# The newest score of each client, kept up to date by every scoring run.
CLIENT_SCORES = struct("client_id BIGINT, loan_id BIGINT, pred_status STRING, score_timestamp TIMESTAMP")

# One row per client. The ids of the last order and transaction, client_ts and account_ts (when the
# client's and the account's own cells were looked up) make a merge of two such tables give the same row in
# whatever order they are merged.
CUSTOMER_360 = struct(
    "client_id BIGINT, birth_number STRING, client_district_id BIGINT, client_ts TIMESTAMP, account_id BIGINT, "
    "account_district_id BIGINT, account_ts TIMESTAMP, "
    "loan_id BIGINT, last_loan_amount DOUBLE, last_loan_status STRING, last_loan_ts TIMESTAMP, "
    "last_default_pred_status STRING, last_default_score_ts TIMESTAMP, "
    "last_order_id BIGINT, last_order_amount DOUBLE, last_order_k_symbol STRING, last_order_ts TIMESTAMP, "
    "last_trans_id BIGINT, last_trans_amount DOUBLE, last_trans_type STRING, last_trans_operation STRING, "
    "last_trans_ts TIMESTAMP"
)
