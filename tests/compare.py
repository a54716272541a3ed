"""Compare registered queries with their SQL, value by value and regardless of row order."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(r[i] for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.sql(sql)
    wanted = rows_of(result.columns, result.fetchall())
    if found[0] != wanted[0]:
        return f"columns {found[0]} instead of {wanted[0]}"
    extra, lost = found[1] - wanted[1], wanted[1] - found[1]
    if extra or lost:
        return (
            f"{sum(found[1].values())} rows instead of {sum(wanted[1].values())}; {sum(extra.values())} extra such as "
            f"{list(extra)[:2]}, {sum(lost.values())} missing such as {list(lost)[:2]}"
        )
    return None
