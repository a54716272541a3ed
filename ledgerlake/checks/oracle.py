"""The SQL that each registered query must agree with, written from the table definitions.

``VIEWS`` holds named subqueries; a statement is given the ones it mentions, in order.
"""

from __future__ import annotations

import re

PAIR = 1_000_000
AS_OF = "DATE '2001-08-01'"
T0, T1, T2 = (f"2025-0{m}-01 00:00:00" for m in (1, 2, 3))
FAR = "9999-12-31 23:59:59"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


def dsum(expr: str) -> str:
    return f"CAST(SUM({dec(expr)}) AS DOUBLE)"


def mean(expr: str) -> str:
    return f"CAST(SUM({dec(expr)}) AS DOUBLE) / CAST(COUNT({expr}) AS DOUBLE)"


def dirty_id(key: str, value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return (
        f"CASE WHEN ({key}) % 11 = 0 THEN 'x' || {text} WHEN ({key}) % 37 = 5 THEN {text} || '00000000000000000000' "
        f"WHEN ({key}) % 23 = 0 THEN NULL ELSE {text} END"
    )


def dirty_text(key: str, value: str) -> str:
    return f"CASE WHEN ({key}) % 13 = 0 THEN '' WHEN ({key}) % 17 = 0 THEN NULL ELSE {value} END"


def dirty_date(key: str, tail: str) -> str:
    month = f"lpad(CAST(1 + ({key}) % 12 AS VARCHAR), 2, '0')"
    day = f"lpad(CAST(1 + ({key}) % 28 AS VARCHAR), 2, '0')"
    return (
        f"CASE WHEN ({key}) % 7 = 0 THEN '259931{tail}' WHEN ({key}) % 5 = 0 THEN '' "
        f"WHEN ({key}) % 29 = 0 THEN NULL ELSE '25' || {month} || {day} || '{tail}' END"
    )


def history(rows: str, key: str) -> str:
    return f"""
      SELECT *, TRUE AS is_current, CASE WHEN {key} % 10 = 3 THEN 2 ELSE 1 END AS scd_version,
             CASE WHEN {key} % 10 = 3 THEN '2024-01-01 00:00:00' ELSE '2020-01-01 00:00:00' END AS effective_from,
             '{FAR}' AS effective_to
      FROM {rows}
      UNION ALL
      SELECT *, FALSE, 1, '2020-01-01 00:00:00', '2024-01-01 00:00:00' FROM {rows} WHERE {key} % 10 = 3"""


def digits(expr: str) -> str:
    return f"(regexp_matches({expr}, '^[0-9]+$') AND TRY_CAST({expr} AS BIGINT) IS NOT NULL)"


def filled(expr: str) -> str:
    return f"({expr} IS NOT NULL AND {expr} <> '')"


def event(kind: str, columns: str) -> str:
    """Decoded events: malformed ones are missing, mistyped accounts NULL."""
    k = f"{kind}_id"
    return f"""
      SELECT {k} AS raw_id,
             CASE WHEN {k} % 43 = 0 THEN NULL ELSE {k} END AS {k},
             CASE WHEN {k} % 53 = 0 THEN NULL ELSE account_id END AS account_id,
             CASE WHEN {k} % 47 = 0 THEN NULL ELSE client_id END AS client_id,
             disp_id, district_id,
             CASE WHEN {k} % 31 = 0 THEN 0.0 WHEN {k} % 41 = 0 THEN -amount
                  WHEN {k} % 59 = 0 THEN 1e17 WHEN {k} % 37 = 0 THEN NULL ELSE amount END AS amount,
             date_trunc('second', ingest_ts) AS ingest_ts, {columns}
      FROM fact_{kind} WHERE {k} % 29 <> 0"""


def newest_event(kind: str, cells: str, where: str = "TRUE") -> str:
    order = ", ".join(f"{x} DESC NULLS LAST" for x in ["ingest_ts", f"{kind}_id", *cells.split(", "), "account_id"])
    return f"""
      SELECT * FROM (
        SELECT client_id, account_id, {kind}_id, {cells}, ingest_ts,
               ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY {order}) AS place
        FROM event_{kind} WHERE {kind}_id IS NOT NULL AND client_id IS NOT NULL AND {where}
      ) WHERE place = 1"""


# The record's columns, in order, with the type an absent one has.
RECORD = {
    "client_id": "BIGINT", "birth_number": "VARCHAR", "client_district_id": "BIGINT", "client_ts": "TIMESTAMP",
    "account_id": "BIGINT",
    "account_district_id": "BIGINT", "account_ts": "TIMESTAMP",
    "loan_id": "BIGINT", "last_loan_amount": "DOUBLE", "last_loan_status": "VARCHAR", "last_loan_ts": "TIMESTAMP",
    "last_default_pred_status": "VARCHAR", "last_default_score_ts": "TIMESTAMP",
    "last_order_id": "BIGINT", "last_order_amount": "DOUBLE", "last_order_k_symbol": "VARCHAR",
    "last_order_ts": "TIMESTAMP",
    "last_trans_id": "BIGINT", "last_trans_amount": "DOUBLE", "last_trans_type": "VARCHAR",
    "last_trans_operation": "VARCHAR", "last_trans_ts": "TIMESTAMP",
}


def record(kind: str, source: str, scored: bool, clients: str = "clients") -> str:
    cells = {
        "loan": {"loan_id": "e.loan_id", "last_loan_amount": "e.amount", "last_loan_status": "e.status"},
        "order": {
            "last_order_id": "e.order_id", "last_order_amount": "e.amount", "last_order_k_symbol": "e.k_symbol",
        },
        "trans": {
            "last_trans_id": "e.trans_id", "last_trans_amount": "e.amount", "last_trans_type": "e.trans_type",
            "last_trans_operation": "e.operation",
        },
    }[kind]
    given = {
        "client_id": "e.client_id", "birth_number": "p.birth_number", "client_district_id": "p.district_id",
        "client_ts": "CASE WHEN p.client_id IS NOT NULL THEN e.ingest_ts END",
        "account_id": "a.account_id", "account_district_id": "a.district_id",
        "account_ts": "CASE WHEN a.account_id IS NOT NULL THEN e.ingest_ts END",
        f"last_{kind}_ts": "e.ingest_ts", **cells,
    }
    joined = ""
    if scored:
        given |= {"last_default_pred_status": "g.pred_status", "last_default_score_ts": "g.score_timestamp"}
        joined = " LEFT JOIN client_score g ON g.client_id = e.client_id"
    columns = ", ".join(f"CAST({given.get(n, 'NULL')} AS {t}) AS {n}" for n, t in RECORD.items())
    return f"""
      SELECT {columns} FROM {source} e
      LEFT JOIN {clients} p ON p.client_id = e.client_id
      LEFT JOIN accounts a ON a.account_id = e.account_id{joined}"""


def merged(records: str) -> str:
    """One row per client: per cell the newest value that is not NULL."""

    def newest(cell: str, *order: str) -> str:
        by = ", ".join(f"{o} DESC NULLS LAST" for o in (*order, cell))
        return f"first({cell} ORDER BY {by}) FILTER (WHERE {cell} IS NOT NULL) AS {cell}"

    cells = [
        newest("birth_number", "client_ts"), newest("client_district_id", "client_ts"),
        "max(client_ts) AS client_ts",
        newest("account_id", "account_ts"), newest("account_district_id", "account_ts", "account_id"),
        "max(account_ts) AS account_ts",
        newest("loan_id", "last_loan_ts"), newest("last_loan_amount", "last_loan_ts", "loan_id"),
        newest("last_loan_status", "last_loan_ts", "loan_id"), "max(last_loan_ts) AS last_loan_ts",
        newest("last_default_pred_status", "last_default_score_ts"),
        "max(last_default_score_ts) AS last_default_score_ts",
    ]
    for kind, rest in (("order", ["amount", "k_symbol"]), ("trans", ["amount", "type", "operation"])):
        cells.append(newest(f"last_{kind}_id", f"last_{kind}_ts"))
        cells += [newest(f"last_{kind}_{r}", f"last_{kind}_ts", f"last_{kind}_id") for r in rest]
        cells.append(f"max(last_{kind}_ts) AS last_{kind}_ts")
    return f"SELECT client_id, {', '.join(cells)} FROM ({records}) GROUP BY client_id"


def show_record(rows: str) -> str:
    columns = ", ".join(f"{ts(n)} AS {n}" if t == "TIMESTAMP" else n for n, t in RECORD.items())
    return f"SELECT {columns} FROM ({rows})"


LOAN_CELLS, ORDER_CELLS, TRANS_CELLS = "amount, status", "amount, k_symbol", "amount, trans_type, operation"
CELLS = {"loan": LOAN_CELLS, "order": ORDER_CELLS, "trans": TRANS_CELLS}

VIEWS = {
    "districts": """
      SELECT CAST(n_nationkey AS BIGINT) AS district_id, n_name AS district_name, r_name AS region
      FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "clients": """
      SELECT c_custkey AS client_id, c_name AS birth_number, CAST(c_nationkey AS BIGINT) AS district_id FROM customer""",
    "accounts": """
      SELECT s_suppkey AS account_id, CAST(s_nationkey AS BIGINT) AS district_id,
             CASE WHEN s_acctbal < 3000 THEN 'MONTHLY' WHEN s_acctbal < 7000 THEN 'WEEKLY' ELSE 'PER_TRANS' END
               AS frequency,
             DATE '1995-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS open_date
      FROM supplier""",
    "disps": f"""
      SELECT o_custkey * {PAIR} + l_suppkey AS disp_id, o_custkey AS client_id, l_suppkey AS account_id,
             CASE WHEN MIN(l_linenumber) = 1 THEN 'OWNER' ELSE 'DISPONENT' END AS disp_type
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY o_custkey, l_suppkey""",
    "cards": f"""
      SELECT o_custkey * {PAIR} + l_suppkey AS card_id, o_custkey * {PAIR} + l_suppkey AS disp_id,
             CASE WHEN MAX(l_quantity) >= 49 THEN 'gold' WHEN MAX(l_quantity) >= 47 THEN 'classic' ELSE 'junior' END
               AS card_type
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey
      WHERE l_returnflag = 'R' AND l_quantity >= 45 GROUP BY o_custkey, l_suppkey""",
    "dim_district": history("districts", "district_id"),
    "dim_client": history("clients", "client_id"),
    "dim_account": history("accounts", "account_id"),
    "dim_disp": history("disps", "disp_id"),
    "dim_card": history("cards", "card_id"),
    "fact_loan": f"""
      SELECT o_orderkey AS loan_id, f.account_id, o_custkey AS client_id,
             o_custkey * {PAIR} + f.account_id AS disp_id, p.district_id, CAST(o_orderdate AS DATE) AS loan_date,
             o_totalprice AS amount, m.months AS duration, o_totalprice / m.months AS payments,
             o_orderstatus AS status, a.district_id AS account_dim_district_id, o_orderdate AS ingest_ts
      FROM orders
      JOIN (VALUES ('1-URGENT', 12), ('2-HIGH', 24), ('3-MEDIUM', 36), ('4-NOT SPECIFIED', 60), ('5-LOW', 72))
        m(priority, months) ON m.priority = o_orderpriority
      LEFT JOIN (SELECT l_orderkey, MIN(l_suppkey) AS account_id FROM lineitem GROUP BY l_orderkey) f
        ON f.l_orderkey = o_orderkey
      LEFT JOIN clients p ON p.client_id = o_custkey
      LEFT JOIN accounts a ON a.account_id = f.account_id""",
    "fact_order": f"""
      SELECT event_id AS order_id, event_id % 10 AS account_id, user_id AS client_id,
             user_id * {PAIR} + event_id % 10 AS disp_id, p.district_id,
             'B' || CAST(event_id % 7 AS VARCHAR) AS bank_to, 'A' || CAST(user_id % 97 AS VARCHAR) AS account_to,
             value AS amount, CASE WHEN event_type <> 'view' THEN event_type END AS k_symbol,
             a.district_id AS account_dim_district_id, ts AS ingest_ts
      FROM events LEFT JOIN clients p ON p.client_id = user_id
      LEFT JOIN accounts a ON a.account_id = event_id % 10""",
    "fact_trans": f"""
      SELECT l_orderkey * 10 + l_linenumber AS trans_id, l_suppkey AS account_id, o_custkey AS client_id,
             o_custkey * {PAIR} + l_suppkey AS disp_id, p.district_id, CAST(l_shipdate AS DATE) AS trans_date,
             CASE l_returnflag WHEN 'R' THEN 'VYDAJ' ELSE 'PRIJEM' END AS trans_type,
             CASE l_linestatus WHEN 'O' THEN 'VKLAD' ELSE 'VYBER' END AS operation,
             CASE WHEN l_returnflag || l_linestatus = 'AF' THEN -l_extendedprice ELSE l_extendedprice END AS amount,
             l_extendedprice * (1 - l_discount) AS balance,
             CASE WHEN l_quantity < 10 THEN 'SIPO' END AS k_symbol, CAST(NULL AS VARCHAR) AS bank,
             CAST(l_partkey % 100 AS VARCHAR) AS account,
             a.district_id AS account_dim_district_id, l_shipdate AS ingest_ts
      FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
      LEFT JOIN clients p ON p.client_id = o_custkey
      LEFT JOIN accounts a ON a.account_id = l_suppkey""",
    # raw tables with faults
    "raw_district": f"""
      SELECT {dirty_id('district_id', 'district_id')} AS A1, {dirty_text('district_id', 'district_name')} AS A2,
             region AS A3,
             {', '.join(
                 f"CAST(district_id * {i} AS VARCHAR) AS A{i}" if i in (4, 5, 6, 7, 8, 9, 11, 14, 16) else
                 {10: "district_id || '.5' AS A10", 13: "district_id || '.75' AS A13",
                  12: "CASE WHEN district_id % 7 = 0 THEN '?' ELSE district_id || '.25' END AS A12",
                  15: "CASE WHEN district_id % 7 = 0 THEN '?' ELSE (district_id * 15) || '.9' END AS A15"}[i]
                 for i in range(4, 17))}
      FROM districts""",
    "raw_client": f"""
      SELECT {dirty_id('client_id', 'client_id')} AS client_id, {dirty_text('client_id', 'birth_number')}
               AS birth_number,
             CASE WHEN client_id % 19 = 0 THEN '999' ELSE CAST(district_id AS VARCHAR) END AS district_id
      FROM clients""",
    "raw_account": f"""
      SELECT {dirty_id('account_id', 'account_id')} AS account_id,
             CASE WHEN account_id % 19 = 0 THEN 'D9' ELSE CAST(district_id AS VARCHAR) END AS district_id,
             {dirty_text('account_id', 'frequency')} AS frequency, {dirty_date('account_id', '')} AS created_date
      FROM accounts""",
    "raw_disp": f"""
      SELECT {dirty_id('client_id * 7 + account_id', 'disp_id')} AS disp_id,
             CAST(client_id AS VARCHAR) AS client_id,
             CASE WHEN (client_id * 7 + account_id) % 19 = 0 THEN '' ELSE CAST(account_id AS VARCHAR) END
               AS account_id,
             CASE WHEN (client_id * 7 + account_id) % 13 = 0 THEN 'DISPOSER'
                  WHEN (client_id * 7 + account_id) % 17 = 0 THEN NULL ELSE disp_type END AS type
      FROM disps""",
    "raw_card": f"""
      SELECT {dirty_id('k', 'card_id')} AS card_id, CAST(disp_id AS VARCHAR) AS disp_id,
             {dirty_text('k', 'card_type')} AS type, {dirty_date('k', ' 10:30:00')} AS issued
      FROM (SELECT *, disp_id // {PAIR} * 7 + disp_id % {PAIR} AS k FROM cards)""",
    # cleaned tables
    "silver_district": f"""
      SELECT TRY_CAST(A1 AS BIGINT) AS district_id, A2 AS district_name, A3 AS region,
             {', '.join(
                 f"TRY_CAST(A{i} AS DOUBLE) AS A{i}" if i in (10, 12, 13)
                 else f"CAST(trunc(TRY_CAST(A{i} AS DOUBLE)) AS INTEGER) AS A{i}" for i in range(4, 17))}
      FROM raw_district WHERE {digits('A1')} AND {filled('A2')} AND {filled('A3')}""",
    "silver_client": f"""
      SELECT TRY_CAST(client_id AS BIGINT) AS client_id, birth_number, TRY_CAST(district_id AS BIGINT) AS district_id
      FROM raw_client
      WHERE {digits('client_id')} AND {digits('district_id')} AND {filled('birth_number')}
        AND TRY_CAST(district_id AS BIGINT) IN (SELECT district_id FROM silver_district)""",
    "silver_account": f"""
      SELECT TRY_CAST(account_id AS BIGINT) AS account_id, TRY_CAST(district_id AS BIGINT) AS district_id, frequency,
             CAST(CAST(try_strptime(created_date, '%y%m%d') AS DATE) AS VARCHAR) AS open_date
      FROM raw_account WHERE {digits('account_id')} AND {digits('district_id')} AND {filled('frequency')}""",
    "silver_disp": f"""
      SELECT TRY_CAST(disp_id AS BIGINT) AS disp_id, TRY_CAST(client_id AS BIGINT) AS client_id,
             TRY_CAST(account_id AS BIGINT) AS account_id, type AS disp_type
      FROM raw_disp
      WHERE {digits('disp_id')} AND {digits('client_id')} AND {digits('account_id')}
        AND type IN ('OWNER', 'DISPONENT')""",
    "silver_card": f"""
      SELECT TRY_CAST(card_id AS BIGINT) AS card_id, TRY_CAST(disp_id AS BIGINT) AS disp_id, type AS card_type,
             {ts("try_strptime(issued, '%y%m%d %H:%M:%S')")} AS issued_at
      FROM raw_card WHERE {digits('card_id')} AND {digits('disp_id')} AND {filled('type')}""",
    # events and customer 360
    "event_loan": event("loan", "CAST(loan_date AS VARCHAR) AS loan_date, duration, payments, status"),
    "event_order": event("order", "bank_to, account_to, k_symbol"),
    "event_trans": event(
        "trans", "CAST(trans_date AS VARCHAR) AS trans_date, trans_type, operation, balance, k_symbol, bank, account"
    ),
    "scores": f"""
      SELECT loan_id, status AS actual_status, 'run_1' AS run_id, TIMESTAMP '{T1}' AS score_timestamp,
             CASE loan_id % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS pred_status FROM fact_loan
      UNION ALL
      SELECT loan_id, status, 'run_2', TIMESTAMP '{T2}', CASE loan_id % 3 WHEN 2 THEN 'F' ELSE 'O' END
      FROM fact_loan""",
    "client_score": """
      SELECT client_id, pred_status, score_timestamp FROM (
        SELECT client_id, pred_status, score_timestamp,
               ROW_NUMBER() OVER (PARTITION BY client_id ORDER BY score_timestamp DESC, s.loan_id DESC) AS place
        FROM scores s JOIN fact_loan USING (loan_id)) WHERE place = 1""",
    **{f"newest_{k}": newest_event(k, cells) for k, cells in CELLS.items()},
    **{f"even_{k}": newest_event(k, cells, f"{k}_id % 2 = 0") for k, cells in CELLS.items()},
    **{f"odd_{k}": newest_event(k, cells, f"{k}_id % 2 = 1") for k, cells in CELLS.items()},
    **{f"record_{k}": record(k, f"newest_{k}", k == "loan") for k in CELLS},
}

# Clients as they were before a move to a district of a smaller number.
BEFORE_MOVE = "(SELECT client_id, birth_number || ' (old)' AS birth_number, district_id + 100 AS district_id FROM clients)"
MOVED = " UNION ALL ".join(
    record(k, f"{half}_{k}", k == "loan", before) for half, before in (("even", BEFORE_MOVE), ("odd", "clients")) for k in CELLS
)
ALL_RECORDS = " UNION ALL ".join(f"SELECT * FROM record_{k}" for k in CELLS)
HALVES = " UNION ALL ".join(record(k, f"{h}_{k}", k == "loan") for h in ("even", "odd") for k in CELLS)


def rejected(table: str, ok: str, reason: str, day: str = "2001-08-01") -> str:
    return f"""SELECT *, '{day}' AS dq_date, '{reason}' AS dq_reason FROM {table} WHERE ({ok}) IS NOT TRUE"""


ACCOUNT_OK = f"{digits('account_id')} AND {digits('district_id')} AND {filled('frequency')}"
CARD_OK = f"{digits('card_id')} AND {digits('disp_id')} AND {filled('type')}"
ACCOUNT_REASON = "Invalid account/district identifiers, frequency, or created_date"
CARD_REASON = "Invalid card/disp identifiers, type, or issued"


def warned(table: str, ok: str, date: str, reason: str) -> str:
    return f"""SELECT *, '2001-08-01' AS dq_date, '{reason}' AS dq_reason FROM {table}
               WHERE {ok} AND COALESCE({date}, '') = ''"""


def one_load(rows: str, key: str, columns: str, change: str) -> str:
    """State after one load: a fifth of the keys is new, a seventh of the rest has changed."""
    names = columns.split(", ")
    before = ", ".join(names)
    after = ", ".join(f"CASE WHEN {key} % 7 = 0 THEN {change.split(':')[1]} ELSE {n} END AS {n}"
                      if n == change.split(":")[0] else n for n in names)
    column, to = change.split(":")
    hit = f"{key} % 5 <> 0 AND {key} % 7 = 0 AND {column} IS DISTINCT FROM {to}"
    return f"""
      SELECT {key}, {after}, '{T1}' AS effective_from, '{FAR}' AS effective_to, TRUE AS is_current, 1 AS scd_version
      FROM {rows} WHERE {key} % 5 = 0
      UNION ALL SELECT {key}, {before}, '{T0}', CASE WHEN {hit} THEN '{T1}' ELSE '{FAR}' END, NOT ({hit}), 1
      FROM {rows} WHERE {key} % 5 <> 0
      UNION ALL SELECT {key}, {after}, '{T1}', '{FAR}', TRUE, 2 FROM {rows} WHERE {hit}"""


# Three states of the client history: a first load, a changed snapshot, and one that changes back
# and lacks every ninth key.
THIRD_STATE = f"""
  SELECT client_id, birth_number, district_id, '{T0}' AS effective_from,
         CASE WHEN client_id % 7 = 0 THEN '{T1}' ELSE '{FAR}' END AS effective_to,
         client_id % 7 <> 0 AS is_current, 1 AS scd_version
  FROM clients WHERE client_id % 5 <> 0
  UNION ALL
  SELECT client_id, birth_number, CASE WHEN client_id % 7 = 0 THEN district_id + 1 ELSE district_id END, '{T1}',
         CASE WHEN client_id % 7 = 0 AND client_id % 9 <> 0 THEN '{T2}' ELSE '{FAR}' END,
         NOT (client_id % 7 = 0 AND client_id % 9 <> 0), CASE WHEN client_id % 5 = 0 THEN 1 ELSE 2 END
  FROM clients WHERE client_id % 5 = 0 OR client_id % 7 = 0
  UNION ALL
  SELECT client_id, birth_number, district_id, '{T2}', '{FAR}', TRUE, CASE WHEN client_id % 5 = 0 THEN 2 ELSE 3 END
  FROM clients WHERE client_id % 7 = 0 AND client_id % 9 <> 0"""


def fact_columns(kind: str, columns: str, rule: str) -> str:
    return f"""SELECT {kind}_id, e.account_id, client_id, disp_id, e.district_id, {columns}, amount,
                      {ts('ingest_ts')} AS ingest_ts, a.district_id AS account_dim_district_id
               FROM event_{kind} e LEFT JOIN accounts a ON a.account_id = e.account_id
               WHERE {kind}_id IS NOT NULL AND amount {rule} 0 AND TRY_CAST(amount AS DECIMAL(18,2)) IS NOT NULL"""


FACT_STATEMENTS = {
    "loan": fact_columns("loan", "loan_date, duration, payments, status", ">"),
    "order": fact_columns("order", "bank_to, account_to, k_symbol", ">"),
    "trans": fact_columns("trans", "trans_date, trans_type, operation, balance, k_symbol, bank, account", "<>"),
}


def missing(name: str, child: str, child_key: str, parent: str, parent_key: str) -> str:
    return f"""SELECT '{name}' AS check_name, COUNT(*) AS bad_fk FROM {child} x
               WHERE NOT EXISTS (SELECT 1 FROM {parent} y WHERE y.{parent_key} = x.{child_key})"""


def number(table: str, key: str) -> str:
    return f"(SELECT TRY_CAST({key} AS BIGINT) AS k, * FROM {table})"


def counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {t}" for n, t in tables.items())


RELATIONS = [
    ("client", "district", "district_id"),
    ("account", "district", "district_id"),
    ("disp", "client", "client_id"),
    ("disp", "account", "account_id"),
    ("card", "disp", "disp_id"),
]

SUMMARY_PARTS = {
    "loan": "MAX(loan_date)", "order": "MAX(CAST(ingest_ts AS DATE))", "trans": "MAX(trans_date)",
}

DAILY = f"""
  SELECT region, trans_date, SUM({dec('amount')}) AS volume FROM fact_trans JOIN districts USING (district_id)
  WHERE trans_date >= {AS_OF} - INTERVAL 120 DAY GROUP BY region, trans_date"""


def rolling(frame: str) -> str:
    return f"""SELECT region, CAST(trans_date AS VARCHAR) AS trans_date, CAST(volume AS DOUBLE) AS daily_amount,
                      CAST(SUM(volume) OVER (PARTITION BY region ORDER BY trans_date {frame}) AS DOUBLE)
                        AS rolling_30d_amount FROM ({DAILY})"""


def account_rolling(frame: str) -> str:
    return f"""SELECT account_id, CAST(trans_date AS VARCHAR) AS trans_date,
                      CAST(SUM(v) OVER (PARTITION BY account_id ORDER BY trans_date {frame}) AS DOUBLE) AS rolling
               FROM (SELECT account_id, trans_date, SUM({dec('amount')}) AS v FROM fact_trans GROUP BY ALL)"""


DAYS_FRAME = "RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW"
ROWS_FRAME = "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"

def cents(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"


# The delivered files: kind, table, values in the file's order.
DELIVERED = [
    ("district", "raw_district", [f"A{i}" for i in range(1, 17)]),
    ("client", "raw_client", ["client_id", "birth_number", "district_id"]),
    ("account", "raw_account", ["account_id", "district_id", "frequency", "created_date"]),
    ("disp", "raw_disp", ["disp_id", "client_id", "account_id", "type"]),
    ("card", "raw_card", ["card_id", "disp_id", "type", "issued"]),
    ("loan", "fact_loan", ["loan_id", "account_id", "strftime(loan_date, '%y%m%d')", cents("amount"), "duration",
                           "duration * 10", "status || ';'"]),
    ("order", "fact_order", ["order_id", "account_id", "';' || bank_to", "account_to", cents("amount"), "k_symbol"]),
    ("trans", "fact_trans", ["trans_id", "account_id", "strftime(fact_trans.trans_date, '%y%m%d')", "trans_type",
                             "operation || ';' || trans_type", cents("amount"), "CAST(floor(balance) AS BIGINT)", "k_symbol", "NULL", "account"]),
]

NO_NUMBERS = ", ".join(f"CAST(NULL AS {'DOUBLE' if i in (10, 12, 13) else 'INTEGER'}) AS A{i}" for i in range(4, 17))
COPIES = {
    "dim_district": f"SELECT *, {NO_NUMBERS} FROM dim_district",
    "dim_client": "SELECT * FROM dim_client",
    "dim_account": "SELECT * REPLACE (CAST(open_date AS VARCHAR) AS open_date) FROM dim_account",
    "dim_disp": "SELECT * FROM dim_disp",
    "dim_card": "SELECT *, '2019-05-01 10:00:00' AS issued_at FROM dim_card",
    **{
        f"fact_{k}": f"SELECT * REPLACE ({ts('ingest_ts')} AS ingest_ts{dated}), CAST(0 AS BIGINT) AS batch_id FROM fact_{k}"
        for k, dated in (("loan", ", CAST(loan_date AS VARCHAR) AS loan_date"), ("order", ""),
                         ("trans", ", CAST(trans_date AS VARCHAR) AS trans_date"))
    },
}

NUMBERED = "(SELECT *, " + ", ".join(
    f"CAST(district_id * {i} + 0.5 AS DOUBLE) AS A{i}" if i in (10, 12, 13) else f"CAST(district_id * {i} AS INTEGER) AS A{i}"
    for i in range(4, 17)) + " FROM districts)"
NUMBERED_COLUMNS = ", ".join(["district_name", "region", *[f"A{i}" for i in range(4, 17)]])

STATEMENTS = {
    # marts
    "bi_s1_current_counts": """
      SELECT (SELECT COUNT(*) FROM dim_client WHERE is_current) AS client_count,
             (SELECT COUNT(*) FROM dim_account WHERE is_current) AS account_count""",
    "bi_s2_loans_by_status": f"""
      SELECT status, {mean('amount')} AS avg_loan_amount,
             CAST(SUM(duration) AS DOUBLE) / COUNT(duration) AS avg_duration_months, COUNT(*) AS loan_count
      FROM fact_loan GROUP BY status""",
    "bi_s3_daily_trans": f"""
      SELECT CAST(trans_date AS VARCHAR) AS trans_date, COUNT(*) AS transaction_count,
             {dsum('amount')} AS total_amount, {dsum('abs(amount)')} AS total_abs_amount
      FROM fact_trans WHERE trans_date >= {AS_OF} - INTERVAL 30 DAY GROUP BY trans_date""",
    "bi_m1_loans_by_district": f"""
      SELECT region, district_name, COUNT(*) AS loan_count, {dsum('amount')} AS total_loan_amount,
             {mean('amount')} AS avg_loan_amount
      FROM fact_loan f JOIN dim_district d ON d.district_id = f.district_id AND d.is_current
      GROUP BY region, district_name""",
    "bi_m2_top_outgoing": f"""
      SELECT account_id, outgoing_amount, txn_count FROM (
        SELECT account_id, COUNT(*) AS txn_count,
               COALESCE(CAST(SUM({dec('amount')}) FILTER (WHERE trans_type = 'VYDAJ') AS DOUBLE), 0)
                 AS outgoing_amount
        FROM fact_trans GROUP BY account_id)
      WHERE outgoing_amount > 0 ORDER BY outgoing_amount DESC, account_id LIMIT 10""",
    "bi_m3_monthly_loans": f"""
      SELECT CAST(CAST(date_trunc('month', loan_date) AS DATE) AS VARCHAR) AS loan_month, COUNT(*) AS loan_count,
             {dsum('amount')} AS total_loan_amount, {mean('amount')} AS avg_loan_amount
      FROM fact_loan GROUP BY ALL""",
    "bi_m4_orders_by_purpose": f"""
      SELECT IFNULL(k_symbol, '(none)') AS k_symbol, COUNT(*) AS order_count, {dsum('amount')} AS total_amount,
             {mean('amount')} AS avg_amount
      FROM fact_order GROUP BY 1""",
    "bi_m5_card_penetration": """
      SELECT region, district_name, COUNT(*) AS total_clients,
             COUNT(*) FILTER (WHERE has_card) AS clients_with_card,
             CAST(COUNT(*) FILTER (WHERE has_card) AS DOUBLE) / COUNT(*) AS card_penetration_ratio
      FROM (SELECT district_id, client_id IN (SELECT client_id FROM cards JOIN disps USING (disp_id)) AS has_card
            FROM clients) JOIN districts USING (district_id)
      GROUP BY region, district_name""",
    "bi_c1_client_summary": f"""
      SELECT p.client_id, p.birth_number, p.district_id AS client_district_id,
             (SELECT COUNT(DISTINCT x.account_id) FROM disps x JOIN accounts USING (account_id)
              WHERE x.client_id = p.client_id) AS account_count,
             {', '.join(f"COALESCE({k}_part.n, 0) AS {k}_count" for k in SUMMARY_PARTS)},
             COALESCE(loan_part.total, 0) AS total_loan_amount, COALESCE(order_part.total, 0) AS total_order_amount,
             COALESCE(trans_part.total, 0) AS net_trans_amount,
             CAST(GREATEST({', '.join(
                 f"COALESCE({k}_part.latest, DATE '1900-01-01')" for k in SUMMARY_PARTS)}) AS VARCHAR)
               AS last_activity_date
      FROM clients p
      {' '.join(f'''LEFT JOIN (SELECT client_id, COUNT(*) AS n, {dsum('amount')} AS total, {latest} AS latest
                    FROM fact_{k} GROUP BY client_id) {k}_part ON {k}_part.client_id = p.client_id'''
                for k, latest in SUMMARY_PARTS.items())}""",
    "bi_c2_rolling_range": rolling(DAYS_FRAME),
    "bi_c2_rolling_rows": rolling(ROWS_FRAME),
    "bi_c3_active_districts": f"""
      SELECT region, district_name, active_loan_clients
      FROM (SELECT district_id, COUNT(DISTINCT client_id) AS active_loan_clients FROM fact_loan
            WHERE loan_date >= {AS_OF} - INTERVAL 6 MONTH GROUP BY district_id) JOIN districts USING (district_id)
      ORDER BY active_loan_clients DESC, region, district_name LIMIT 20""",
    "bi_c4_loan_segments": f"""
      SELECT duration_bucket, amount_bucket, status, COUNT(*) AS loan_count, {dsum('amount')} AS total_amount,
             {mean('amount')} AS avg_amount
      FROM (SELECT *, CASE WHEN duration <= 12 THEN '0-12m' WHEN duration <= 36 THEN '13-36m'
                           WHEN duration <= 60 THEN '37-60m' ELSE '60m+' END AS duration_bucket,
                   CASE WHEN amount < 50000 THEN '<50k' WHEN amount < 150000 THEN '50k-150k'
                        WHEN amount < 300000 THEN '150k-300k' ELSE '300k+' END AS amount_bucket FROM fact_loan)
      GROUP BY ALL""",
    "bi_c5_profitability": f"""
      SELECT client_id, birth_number, CAST(a AS DOUBLE) AS total_loan_outflow, CAST(b AS DOUBLE) AS total_order_outflow,
             CAST(n AS DOUBLE) AS net_trans_amount, CAST(n - a - b AS DOUBLE) AS profitability_proxy
      FROM (SELECT client_id, birth_number,
              {', '.join(f"COALESCE((SELECT SUM({dec('f.amount')}) FROM fact_{k} f WHERE f.client_id = p.client_id), 0)"
                         f" AS {x}" for k, x in (("loan", "a"), ("order", "b"), ("trans", "n")))}
            FROM clients p)
      ORDER BY profitability_proxy DESC, client_id LIMIT 50""",
    # sources and sinks
    # An empty value in a file is a missing one.
    "src_delimited": " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, concat_ws('|', "
        + ", ".join(f"COALESCE(NULLIF(CAST({value} AS VARCHAR), ''), '(null)')" for value in values)
        + f") AS line FROM {table}"
        for kind, table, values in DELIVERED
    ),
    "bronze_strip_quotes": """
      SELECT CAST(account_id AS VARCHAR) AS account_id, CAST(district_id AS VARCHAR) AS district_id, frequency,
             CAST(open_date AS VARCHAR) AS open_date FROM accounts""",
    "export_roundtrip": f"""
      SELECT loan_id, account_id, client_id, disp_id, district_id, CAST(loan_date AS VARCHAR) AS loan_date, amount,
             duration, payments, status, account_dim_district_id, {ts('ingest_ts')} AS ingest_ts,
             CAST(0 AS BIGINT) AS batch_id
      FROM fact_loan""",
    **{f"stage_import_{n}": sql for n, sql in COPIES.items()},
    "stage_import": """
      SELECT * FROM dim_card UNION ALL BY NAME
      SELECT disp_id AS card_id, disp_id, disp_type AS card_type, effective_from, effective_to, is_current, scd_version
      FROM dim_disp""",
    "chk_import_counts": counts(
        {t: t for t in ["dim_district", "dim_client", "dim_account", "dim_disp", "dim_card",
                        "fact_loan", "fact_order", "fact_trans"]}),
    "json_parse": """
      SELECT e.loan_id, e.account_id, e.district_id, e.client_id, e.disp_id, e.loan_date AS date, e.amount, e.duration,
             e.payments, e.status, strftime(e.ingest_ts, '%Y-%m-%dT%H:%M:%SZ') AS ingest_ts
      FROM fact_loan f LEFT JOIN event_loan e ON e.raw_id = f.loan_id""",
    "json_drift": """
      SELECT loan_id, 'channel' AS field, FALSE AS known, '{"no":' || loan_id || '}' AS value, loan_id AS number
      FROM event_loan WHERE loan_id IS NOT NULL AND amount > 0 AND amount < 1e16
      UNION ALL
      SELECT e.loan_id, 'account_id', TRUE, '"none"', NULL
      FROM event_loan e JOIN fact_loan f ON f.loan_id = e.raw_id
      WHERE e.loan_id IS NOT NULL AND e.amount > 0 AND e.amount < 1e16 AND raw_id % 53 = 0 AND f.account_id IS NOT NULL""",
    # cleaning
    **{f"silver_{n}": f"SELECT * FROM silver_{n}" for n in ("district", "client", "account", "disp", "card")},
    "dq_district": rejected(
        "raw_district", f"{digits('A1')} AND {filled('A2')} AND {filled('A3')}",
        "Invalid district id or missing name/region"),
    "dq_client": rejected(
        "raw_client",
        f"{digits('client_id')} AND {digits('district_id')} AND {filled('birth_number')} AND "
        "TRY_CAST(district_id AS BIGINT) IN (SELECT s.district_id FROM silver_district s)",
        "Invalid client_id/district_id format, missing birth_number, or unknown district_id"),
    "dq_account": rejected("raw_account", ACCOUNT_OK, ACCOUNT_REASON),
    "dq_account_strict": rejected("raw_account", f"{ACCOUNT_OK} AND {filled('created_date')}", ACCOUNT_REASON),
    "dq_account_warned": warned("raw_account", ACCOUNT_OK, "created_date", ACCOUNT_REASON),
    "dq_appended": rejected("raw_account", ACCOUNT_OK, ACCOUNT_REASON) + " UNION ALL "
        + rejected("raw_account", ACCOUNT_OK, ACCOUNT_REASON, "2001-08-02"),
    "dq_disp": rejected(
        "raw_disp",
        f"{digits('disp_id')} AND {digits('client_id')} AND {digits('account_id')} AND type IN ('OWNER', 'DISPONENT')",
        "Invalid disposition identifiers or type"),
    "dq_card": rejected("raw_card", CARD_OK, CARD_REASON),
    "dq_card_warned": warned("raw_card", CARD_OK, "issued", CARD_REASON),
    # history
    "scd2_initial": f"""
      SELECT *, '{T0}' AS effective_from, '{FAR}' AS effective_to, TRUE AS is_current, 1 AS scd_version FROM clients""",
    "scd2_new_keys": """
      SELECT client_id, birth_number, CASE WHEN client_id % 7 = 0 THEN district_id + 1 ELSE district_id END
        AS district_id FROM clients WHERE client_id % 5 = 0""",
    "scd2_changed": """
      SELECT client_id, birth_number, district_id + 1 AS district_id, 2 AS scd_version
      FROM clients WHERE client_id % 7 = 0 AND client_id % 5 <> 0""",
    "scd2_expired": f"""
      SELECT *, '{T0}' AS effective_from, '{T1}' AS effective_to, FALSE AS is_current, 1 AS scd_version
      FROM clients WHERE client_id % 7 = 0 AND client_id % 5 <> 0""",
    "scd2_state": THIRD_STATE,
    "scd2_current": f"SELECT * FROM ({THIRD_STATE}) WHERE is_current",
    "scd2_state_district": one_load(NUMBERED, "district_id", NUMBERED_COLUMNS, "region:'MOVED'"),
    "scd2_state_district_number": one_load(NUMBERED, "district_id", NUMBERED_COLUMNS, "A12:NULL"),
    "scd2_state_account": one_load(
        "(SELECT * REPLACE (CAST(open_date AS VARCHAR) AS open_date) FROM accounts)", "account_id",
        "district_id, frequency, open_date", "open_date:NULL"),
    "scd2_state_disp": one_load("disps", "disp_id", "client_id, account_id, disp_type", "disp_type:'CLOSED'"),
    "scd2_state_card": one_load(
        "(SELECT *, '2019-05-01 10:00:00' AS issued_at FROM cards)", "card_id",
        "disp_id, card_type, issued_at", "card_type:NULL"),
    "dimensions_end_to_end": counts(
        {f"{n}_silver": f"silver_{n}" for n in ("district", "client", "account", "disp", "card")}
        | {f"dim_{n}": f"silver_{n}" for n in ("district", "client", "account", "disp", "card")})
        + " UNION ALL " + " UNION ALL ".join(
            f"SELECT 'dq_{n}', (SELECT COUNT(*) FROM raw_{n}) - (SELECT COUNT(*) FROM silver_{n})"
            for n in ("district", "client", "account", "disp", "card")),
    # facts
    **{f"stream_fact_{k}": q for k, q in FACT_STATEMENTS.items()},
    "dq_events": " UNION ALL ".join(
        f"""SELECT '{k}' AS kind, (SELECT COUNT(*) FROM fact_{k}) - (SELECT COUNT(*) FROM ({q})) AS rejected,
            'Malformed event, missing id, or amount missing, out of range or of the wrong sign' AS dq_reason"""
        for k, q in FACT_STATEMENTS.items()),
    **{f"batch_fact_{k}": q for k, q in FACT_STATEMENTS.items()},
    "fact_compacted_trans": FACT_STATEMENTS["trans"],
    "fact_enrich_account": f"SELECT * REPLACE ({ts('ingest_ts')} AS ingest_ts) FROM fact_order",
    "jn_stream_static": """
      SELECT order_id, account_id, amount, (SELECT frequency FROM accounts a WHERE a.account_id = f.account_id)
        AS frequency FROM fact_order f""",
    # customer 360
    **{f"c360_{k}": show_record(f"SELECT * FROM record_{k}") for k in CELLS},
    "c360_loan_without_scores": show_record(record("loan", "newest_loan", False)),
    "c360_latest": f"""
      SELECT client_id, account_id, trans_id, amount, trans_type AS type, operation, {ts('ingest_ts')} AS ingest_ts
      FROM newest_trans""",
    "c360_latest_score": f"SELECT client_id, pred_status, {ts('score_timestamp')} AS score_timestamp FROM client_score",
    "c360_merged": show_record(merged(ALL_RECORDS)),
    "stream_c360": show_record(merged(ALL_RECORDS)),
    "c360_lookup": show_record(merged(ALL_RECORDS)) + " WHERE client_id = 7",
    "c360_found": show_record(merged(HALVES)) + " WHERE client_id = 7",
    "c360_upsert": show_record(merged(HALVES)),
    "c360_moved": show_record(merged(MOVED)),
    # joins
    "jn_inner": "SELECT loan_id, district_id, region, district_name FROM fact_loan JOIN districts USING (district_id)",
    "jn_left_current": """
      SELECT loan_id, f.account_id, frequency FROM fact_loan f LEFT JOIN accounts a ON a.account_id = f.account_id""",
    "jn_anti": """
      SELECT loan_id FROM fact_loan f WHERE NOT EXISTS (SELECT 1 FROM accounts a WHERE a.account_id = f.account_id)""",
    "jn_semi": "SELECT order_id FROM fact_order WHERE disp_id IN (SELECT disp_id FROM disps)",
    "jn_existence": """
      SELECT client_id, EXISTS (SELECT 1 FROM silver_district s WHERE s.district_id = TRY_CAST(r.district_id AS BIGINT))
        AS known FROM raw_client r""",
    "jn_star": "SELECT client_id, " + ", ".join(
        f"(SELECT NULLIF(COUNT(*), 0) FROM fact_{k} f WHERE f.client_id = p.client_id) AS {k}s" for k in CELLS)
        + " FROM clients p",
    "jn_bridge": """
      SELECT client_id, p.district_id, card_id FROM cards JOIN disps USING (disp_id) JOIN clients p USING (client_id)""",
    "jn_cast_keys": """
      SELECT TRY_CAST(client_id AS BIGINT) AS client_id, COUNT(*) AS orphans FROM raw_disp
      WHERE client_id NOT IN (SELECT client_id FROM raw_client WHERE client_id IS NOT NULL) GROUP BY 1""",
    "jn_scalar": """
      SELECT (SELECT COUNT(*) FROM orders) AS loans, (SELECT COUNT(*) FROM events) AS orders,
             (SELECT COUNT(*) FROM lineitem) AS trans""",
    # aggregates, windows, sorting, unions
    "ag_basic": f"""
      SELECT account_id, COUNT(*) AS n, {dsum('amount')} AS total_amount, {mean('amount')} AS avg_amount,
             MAX(amount) AS largest FROM fact_trans GROUP BY account_id""",
    "ag_count_distinct": "SELECT account_id, COUNT(DISTINCT client_id) AS clients FROM fact_trans GROUP BY 1",
    "ag_conditional_sum": f"""
      SELECT CAST(trans_date AS VARCHAR) AS trans_date,
             {dsum("CASE WHEN trans_type = 'VYDAJ' THEN amount ELSE 0 END")} AS outgoing,
             {dsum("CASE WHEN trans_type = 'PRIJEM' THEN amount ELSE 0 END")} AS incoming
      FROM fact_trans GROUP BY 1""",
    "ag_having": f"""
      SELECT client_id, COUNT(*) AS n, {dsum('amount')} AS total_amount FROM fact_order GROUP BY client_id
      HAVING SUM({dec('amount')}) > 500""",
    "ag_distinct": "SELECT client_id, account_id FROM fact_trans GROUP BY ALL",
    "ag_group_expr": """
      SELECT CAST(make_date(year(trans_date), month(trans_date), 1) AS VARCHAR) AS month, COUNT(*) AS n
      FROM fact_trans GROUP BY 1""",
    "ag_global_count": "SELECT COUNT(*) AS n FROM lineitem",
    "wn_row_number": f"""
      SELECT account_id, {ts('ingest_ts')} AS ingest_ts, trans_id, amount FROM fact_trans
      QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY fact_trans.ingest_ts DESC, trans_id DESC, amount DESC)
              = 1""",
    "wn_latest": f"""
      SELECT account_id, {ts('ingest_ts')} AS ingest_ts, trans_id, amount FROM fact_trans
      QUALIFY ROW_NUMBER() OVER (PARTITION BY account_id ORDER BY fact_trans.ingest_ts DESC, trans_id DESC, amount DESC)
              = 1""",
    "wn_range_interval": account_rolling(DAYS_FRAME),
    "wn_rows": account_rolling(ROWS_FRAME),
    "so_multi_key": """
      SELECT account_id, client_id, disp_type, is_current,
             ROW_NUMBER() OVER (ORDER BY account_id, client_id DESC, is_current, disp_type, scd_version) AS place
      FROM dim_disp""",
    "fn_current_date": """
      SELECT trans_type, CAST(date_diff('day', MAX(CAST(trans_date AS DATE)), current_date) AS INTEGER) AS days, TRUE AS past
      FROM fact_trans GROUP BY 1""",
    "so_top_k": "SELECT loan_id, amount FROM fact_loan ORDER BY amount DESC, loan_id LIMIT 20",
    "so_limit": "SELECT loan_id, amount, duration, payments, status FROM fact_loan ORDER BY loan_id LIMIT 1000",
    "st_union_all": " UNION ALL ".join(f"SELECT '{k}' AS kind, {k}_id AS id, amount FROM fact_{k}" for k in CELLS),
    # functions
    "fn_cast": """
      SELECT A1, TRY_CAST(A1 AS BIGINT) AS as_long, CAST(trunc(TRY_CAST(A15 AS DOUBLE)) AS INTEGER) AS as_int,
             TRY_CAST(A12 AS DOUBLE) AS as_double, CAST(TRY_CAST('2001-01-0' || A4 AS DATE) AS VARCHAR) AS as_date
      FROM raw_district""",
    "fn_string": f"""
      SELECT client_id, regexp_matches(client_id, '^[0-9]+$') AS digits, {digits('client_id')} AS is_key, {filled('birth_number')} AS present,
             replace(birth_number, '#0', '') AS replaced FROM raw_client""",
    "fn_date": f"""
      SELECT account_id, CAST(d AS VARCHAR) AS day, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month,
             CAST(CAST(d - INTERVAL 30 DAY AS DATE) AS VARCHAR) AS days_before,
             CAST(CAST(d - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS months_before,
             {ts("try_strptime(created_date || ' 23:59:58', '%y%m%d %H:%M:%S')")} AS at,
             d >= DATE '2025-03-30' AS recent
      FROM (SELECT *, CAST(try_strptime(created_date, '%y%m%d') AS DATE) AS d FROM raw_account)""",
    "fn_null": """
      SELECT order_id, COALESCE(k_symbol, '(none)') AS filled, NULLIF(k_symbol, 'click') AS emptied,
             k_symbol IS NOT DISTINCT FROM NULLIF(k_symbol, 'click') AS same,
             CASE WHEN amount > 50 THEN amount ELSE 50.0 END AS at_least_50 FROM fact_order""",
    "fn_conditional": """
      SELECT loan_id,
             CASE WHEN duration > 60 THEN '60m+' WHEN duration > 36 THEN '37-60m' WHEN duration > 12 THEN '13-36m'
                  ELSE '0-12m' END AS duration_bucket,
             CASE WHEN amount >= 300000 THEN '300k+' WHEN amount >= 150000 THEN '150k-300k'
                  WHEN amount >= 50000 THEN '50k-150k' ELSE '<50k' END AS amount_bucket,
             abs(amount - 100000) AS distance FROM fact_loan""",
    "fn_json": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    # checks
    "chk_bronze_fk": " UNION ALL ".join([
        missing("client_district", number("raw_client", "district_id"), "k", number("raw_district", "A1"), "k"),
        missing("account_district", number("raw_account", "district_id"), "k", number("raw_district", "A1"), "k"),
        missing("disp_client", number("raw_disp", "client_id"), "k", number("raw_client", "client_id"), "k"),
        missing("disp_account", number("raw_disp", "account_id"), "k", number("raw_account", "account_id"), "k"),
        missing("card_disp", number("raw_card", "disp_id"), "k", number("raw_disp", "disp_id"), "k"),
    ]),
    "chk_silver_fk": " UNION ALL ".join(
        missing(f"{a}_{b}", f"silver_{a}", key, f"silver_{b}", key) for a, b, key in RELATIONS),
    "chk_gold_dim_fk": """
      SELECT 'client_district' AS check_name, COUNT(*) AS bad_fk FROM clients WHERE district_id % 6 = 0 UNION ALL
      """ + " UNION ALL ".join(
        missing(f"{a}_{b}", f"(SELECT * FROM dim_{a} WHERE is_current)", key,
                f"dim_{b}" if b == "district" else f"(SELECT * FROM dim_{b} WHERE is_current)", key)
        for a, b, key in RELATIONS[1:]),
    "chk_fact_fk": " UNION ALL ".join(
        missing(f"fact_{k}_{b}", f"fact_{k}", f"{b}_id", f"{b}s", f"{b}_id")
        for k in CELLS for b in ("account", "client", "disp")),
    "chk_pk": """
      SELECT 'district' AS table_name, COUNT(*) AS total_rows, COUNT(DISTINCT district_id) AS distinct_keys
      FROM silver_district UNION ALL
      SELECT 'trans', COUNT(*), COUNT(DISTINCT trans_id) FROM fact_trans""",
    "chk_eligible_accounts": f"""
      SELECT COUNT(*) AS eligible FROM raw_account
      WHERE {ACCOUNT_OK} AND regexp_matches(created_date, '^[0-9]{{6}}$')""",
    "chk_row_counts": counts(
        {f"bronze.{n}_bronze": f"raw_{n}" for n in ("district", "client", "account", "disp", "card")}
        | {f"silver.{n}_silver": f"silver_{n}" for n in ("district", "client", "account", "disp", "card")}
        | {"silver.dq_account": f"raw_account WHERE ({ACCOUNT_OK}) IS NOT TRUE"}
        | {f"gold.{n}": n for n in ["dim_district", "dim_client", "dim_account", "dim_disp", "dim_card",
                                    "fact_loan", "fact_order", "fact_trans"]}),
    # model
    "ml_features": """
      SELECT loan_id, amount, duration, payments, status, CAST(DENSE_RANK() OVER (ORDER BY status) - 1 AS DOUBLE) AS label
      FROM fact_loan""",
    "ml_leaderboard": """
      SELECT run, hidden_dim, CAST(learning_rate AS DOUBLE) AS learning_rate, is_accuracy
      FROM (VALUES (0, 16, 0.001, TRUE), (1, 16, 0.0005, TRUE), (2, 32, 0.001, TRUE), (3, 32, 0.0005, TRUE),
                            (4, 64, 0.001, TRUE), (5, 64, 0.0005, TRUE)) t(run, hidden_dim, learning_rate, is_accuracy)""",
    "ml_scores": f"""
      SELECT loan_id, 'run_1' AS run_id, status AS actual_status, '{T1}' AS score_timestamp, TRUE AS adds_up,
             TRUE AS is_likeliest,
             (SELECT '[' || string_agg(DISTINCT status, ', ' ORDER BY status) || ']' FROM fact_loan) AS statuses
      FROM fact_loan""",
    "ml_learned": """
      SELECT CASE WHEN duration >= 60 THEN 'D' WHEN amount > 200000 THEN 'B' ELSE 'A' END AS actual_status, COUNT(*) AS loans,
             TRUE AS learned
      FROM fact_loan GROUP BY 1""",
    "ml_run_accuracy": """
      SELECT run_id, COUNT(*) AS scored, COUNT(*) FILTER (WHERE actual_status = pred_status) AS correct,
             CAST(COUNT(*) FILTER (WHERE actual_status = pred_status) AS DOUBLE) / COUNT(*) AS accuracy
      FROM scores GROUP BY run_id""",
    "ml_numeric_only": """
      SELECT loan_id, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, CAST(duration AS DOUBLE) AS duration,
             CAST(duration * 10 AS DOUBLE) AS payments FROM fact_loan WHERE loan_id % 7 <> 0 AND loan_id % 11 <> 0""",
    # reports
    "rep_deposits_by_branch": f"""
      SELECT district_name AS branch, COUNT(*) AS num_deposits, {dsum('amount')} AS total_deposited
      FROM fact_trans JOIN districts USING (district_id)
      WHERE trans_type = 'PRIJEM' AND trans_date >= {AS_OF} - INTERVAL 7 DAY GROUP BY 1""",
    "rep_daily_by_branch": f"""
      SELECT district_name AS branch, CAST(trans_date AS VARCHAR) AS trans_date, COUNT(*) AS trans_count,
             {dsum('amount')} AS volume
      FROM fact_trans JOIN districts USING (district_id) GROUP BY 1, 2""",
    "rep_monthly_by_branch": f"""
      SELECT district_name AS branch, strftime(trans_date, '%Y-%m-01') AS month, COUNT(*) AS trans_count,
             {dsum('amount')} AS volume
      FROM fact_trans JOIN districts USING (district_id) GROUP BY 1, 2""",
    "rep_daily_by_client": f"""
      SELECT client_id, CAST(trans_date AS VARCHAR) AS trans_date, COUNT(*) AS trans_count, {dsum('amount')} AS volume
      FROM fact_trans GROUP BY 1, 2""",
    "rep_volume_by_type": f"""
      SELECT CAST(trans_date AS VARCHAR) AS trans_date, trans_type, COUNT(*) AS trans_count, {dsum('amount')} AS volume
      FROM fact_trans GROUP BY 1, 2""",
    "rep_clients_by_account_type": """
      SELECT frequency, COUNT(DISTINCT client_id) AS clients FROM disps JOIN accounts USING (account_id) GROUP BY 1""",
    "rep_client_features": f"""
      SELECT p.client_id, t.trans_count, t.avg_monthly_deposit,
             {AS_OF} - (SELECT MIN(open_date) FROM disps d JOIN accounts USING (account_id)
                        WHERE d.client_id = p.client_id) AS account_age_days
      FROM clients p LEFT JOIN (
        SELECT client_id, COUNT(*) AS trans_count,
               CAST(SUM({dec('amount')}) FILTER (WHERE trans_type = 'PRIJEM') AS DOUBLE) /
               NULLIF(COUNT(DISTINCT strftime(trans_date, '%Y%m')) FILTER (WHERE trans_type = 'PRIJEM'), 0)
                 AS avg_monthly_deposit
        FROM fact_trans GROUP BY client_id) t ON t.client_id = p.client_id""",
    "rep_prediction_drift": """
      SELECT run_id, actual_status, pred_status, COUNT(*) AS loans FROM scores GROUP BY ALL""",
    "rep_high_value_high_risk": f"""
      SELECT client_id, total_balance, c_acctbal AS credit_score, 'High' AS risk_segment, birth_number
      FROM (SELECT client_id, {dsum('amount')} AS total_balance FROM fact_trans GROUP BY 1)
      JOIN clients USING (client_id) JOIN customer ON c_custkey = client_id
      WHERE total_balance > 500000 AND c_acctbal < 2000""",
    "rep_large_trans": """
      SELECT trans_id, account_id, amount, amount >= 40000 OR amount <= -40000 AS is_large FROM fact_trans""",
    "rep_running_total": f"""
      SELECT account_id, CAST(trans_date AS VARCHAR) AS trans_date, trans_id, amount,
             CAST(SUM({dec('amount')}) OVER (PARTITION BY account_id ORDER BY fact_trans.trans_date, trans_id, amount
                                             ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM fact_trans""",
    "rep_masked_clients": """
      SELECT client_id, district_id, repeat('*', length(birth_number) - 4) || right(birth_number, 4) AS birth_number,
             sha256(birth_number) AS birth_hash FROM clients""",
    "rep_trans_by_month": f"""
      SELECT trans_id, amount, CAST(trans_date AS VARCHAR) AS trans_date, strftime(trans_date, '%Y-%m-01') AS month
      FROM fact_trans WHERE fact_trans.trans_date >= {AS_OF} - INTERVAL 6 MONTH""",
    "rep_expectations": f"""
      SELECT expectation, COUNT(*) AS checked, COUNT(*) FILTER (WHERE met IS NOT TRUE) AS failed FROM (
        SELECT 'disp_id is a number' AS expectation, {digits('disp_id')} AS met FROM raw_disp UNION ALL
        SELECT 'account_id is present', {filled('account_id')} FROM raw_disp UNION ALL
        SELECT 'type is known', type IN ('OWNER', 'DISPONENT') FROM raw_disp) GROUP BY 1""",
    "stream_ticker": f"""
      SELECT {ts("time_bucket(INTERVAL '5 minutes', ts)")} AS window_start, COUNT(*) AS events, {dsum('value')} AS volume
      FROM events GROUP BY 1""",
}


# The same results by another way.
for _same, _as in {
    "bi_c1_colocated": "bi_c1_client_summary", "bi_c5_colocated": "bi_c5_profitability", "chk_fact_fk_colocated": "chk_fact_fk",
    "chk_stored_counts": "chk_row_counts", "rep_monthly_from_sums": "rep_monthly_by_branch", "rep_expectations_written": "rep_expectations",
    "rep_running_from_sums": "rep_running_total",
}.items():
    STATEMENTS[_same] = STATEMENTS[_as]


def with_views(body: str) -> str:
    """Prefix ``body`` with the views it needs, directly or through other views."""
    needed: set[str] = set()
    todo = [body]
    while todo:
        words = set(re.findall(r"[a-z_0-9]+", todo.pop()))
        for name in (words & VIEWS.keys()) - needed:
            needed.add(name)
            todo.append(VIEWS[name])
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items() if name in needed)
    return f"WITH {parts}\n{body}" if parts else body


def statements() -> dict[str, str]:
    return {name: with_views(body) for name, body in STATEMENTS.items()}
