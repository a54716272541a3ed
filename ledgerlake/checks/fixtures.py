"""Dirty, changed and JSON variants of the sample tables, all computed by Spark from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlake.checks.star import PAIR, Star
from ledgerlake.schemas import EVENTS, HISTORY

c = F.col

AS_OF = "DATE '2001-08-01'"
T0, T1, T2 = (f"TIMESTAMP '2025-0{m}-01 00:00:00'" for m in (1, 2, 3))


def text(value: Column) -> Column:
    return value.cast("string")


def dirty_id(key: Column, value: Column) -> Column:
    """Text ids, some of them not numbers, some too long for one, some missing."""
    return (
        F.when(key % 11 == 0, F.concat(F.lit("x"), text(value)))
        .when(key % 37 == 5, F.concat(text(value), F.lit("00000000000000000000")))
        .when(key % 23 != 0, text(value))
    )


def dirty_text(key: Column, value: Column) -> Column:
    return F.when(key % 13 == 0, F.lit("")).when(key % 17 != 0, value)


def dirty_date(key: Column, tail: str) -> Column:
    """``yyMMdd`` dates, some impossible, some empty, some missing."""
    month, day = F.lpad(text(1 + key % 12), 2, "0"), F.lpad(text(1 + key % 28), 2, "0")
    return (
        F.when(key % 7 == 0, F.lit("259931" + tail))
        .when(key % 5 == 0, F.lit(""))
        .when(key % 29 != 0, F.concat(F.lit("25"), month, day, F.lit(tail)))
    )


class Bronze:
    """Raw string tables with faults."""

    def __init__(self, star: Star):
        self.star = star

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)()

    def district(self) -> DataFrame:
        k = c("district_id")
        numbers = {f"A{i}": text(k * i) for i in (4, 5, 6, 7, 8, 9, 11, 14, 16)}
        numbers |= {
            "A10": F.concat(text(k), F.lit(".5")),
            "A12": F.when(k % 7 == 0, F.lit("?")).otherwise(F.concat(text(k), F.lit(".25"))),
            "A13": F.concat(text(k), F.lit(".75")),
            "A15": F.when(k % 7 == 0, F.lit("?")).otherwise(F.concat(text(k * 15), F.lit(".9"))),
        }
        return self.star.districts().select(
            dirty_id(k, k).alias("A1"),
            dirty_text(k, c("district_name")).alias("A2"),
            c("region").alias("A3"),
            *[numbers[f"A{i}"].alias(f"A{i}") for i in range(4, 17)],
        )

    def client(self) -> DataFrame:
        k = c("client_id")
        return self.star.clients().select(
            dirty_id(k, k).alias("client_id"),
            dirty_text(k, c("birth_number")).alias("birth_number"),
            F.when(k % 19 == 0, F.lit("999")).otherwise(text(c("district_id"))).alias("district_id"),
        )

    def account(self) -> DataFrame:
        k = c("account_id")
        return self.star.accounts().select(
            dirty_id(k, k).alias("account_id"),
            F.when(k % 19 == 0, F.lit("D9")).otherwise(text(c("district_id"))).alias("district_id"),
            dirty_text(k, c("frequency")).alias("frequency"),
            dirty_date(k, "").alias("created_date"),
        )

    def disp(self) -> DataFrame:
        k = c("client_id") * 7 + c("account_id")
        return self.star.disps().select(
            dirty_id(k, c("disp_id")).alias("disp_id"),
            text(c("client_id")).alias("client_id"),
            F.when(k % 19 == 0, F.lit("")).otherwise(text(c("account_id"))).alias("account_id"),
            F.when(k % 13 == 0, F.lit("DISPOSER")).when(k % 17 != 0, c("disp_type")).alias("type"),
        )

    def card(self) -> DataFrame:
        k = F.floor(c("disp_id") / PAIR) * 7 + c("disp_id") % PAIR
        return self.star.cards().select(
            dirty_id(k, c("card_id")).alias("card_id"),
            text(c("disp_id")).alias("disp_id"),
            dirty_text(k, c("card_type")).alias("type"),
            dirty_date(k, " 10:30:00").alias("issued"),
        )


def first_load(rows: DataFrame, key: str) -> DataFrame:
    """Version 1 of four fifths of a dimension's keys."""
    return rows.where(c(key) % 5 != 0).withColumns(
        {
            "effective_from": F.expr(T0),
            "effective_to": F.expr("TIMESTAMP '9999-12-31 23:59:59'"),
            "is_current": F.lit(True),
            "scd_version": F.lit(1).cast(HISTORY["scd_version"].dataType),
        }
    )


def moved(rows: DataFrame, key: str, column: str, to: Column) -> DataFrame:
    """The rows with ``column`` changed where the key divides by seven."""
    return rows.withColumn(column, F.when(c(key) % 7 == 0, to).otherwise(c(column)))


# --- events ---

_SOURCE = {"loan": "orders", "order": "events", "trans": "lineitem"}


class SpreadStar(Star):
    """The sample tables with the one behind a kind of event read by all cores."""

    def __init__(self, spark, sf_dir: str, kind: str):
        super().__init__(spark, sf_dir)
        self.heavy = _SOURCE[kind]

    def base(self, name: str) -> DataFrame:
        rows = super().base(name)
        return spread(rows) if name == self.heavy else rows


def spread(rows: DataFrame) -> DataFrame:
    """Rows for all cores: dealt out where they lie in fewer splits than half the cores, as they are where Spark's own splits feed these.

    Dealing sorts and exchanges whole rows, into no more parts than there are cores however many rows there are. Splits that hold rows are counted without
    reading a column: a file of one row group may have several splits, of which one has the rows.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    busy = rows.select(F.spark_partition_id().alias("split")).distinct().count()
    return rows.repartition(cores) if 2 * busy < cores else rows


class StreamingStar(Star):
    """The sample tables with the one behind a kind of event read as a stream."""

    live = True

    def __init__(self, spark, sf_dir: str, kind: str):
        super().__init__(spark, sf_dir)
        self.moving = _SOURCE[kind]

    def base(self, name: str) -> DataFrame:
        still = super().base(name)
        if name != self.moving:
            return still
        # As a pattern, the path may be one file or a directory of files.
        return self.spark.readStream.schema(still.schema).parquet(f"{self.sf_dir}/{name}.parque[t]")


def broken_amount(key: Column) -> Column:
    return (
        F.when(key % 31 == 0, F.lit(0.0))
        .when(key % 41 == 0, -c("amount"))
        .when(key % 59 == 0, F.lit(1e17))
        .when(key % 37 != 0, c("amount"))
    )


def envelopes(star: Star, kind: str, rest: int | None = None) -> DataFrame:
    """The facts as JSON events, some malformed, mistyped, without id or client, or worthless. ``rest``: those with even (0) or odd (1) numbers."""
    if type(star) is Star:
        star = SpreadStar(star.spark, star.sf_dir, kind)
    key = f"{kind}_id"
    dated = {"loan": "loan_date", "trans": "trans_date"}.get(kind)
    renamed = {"date": dated, "type": "trans_type"}
    wanted = [renamed.get(n, n) for n in EVENTS[kind].names]
    k = c(key)
    facts = star.table(f"fact_{kind}", *wanted)
    facts = facts if rest is None else facts.where(k % 2 == rest)
    values = {
        key: F.when(k % 43 != 0, k),
        "client_id": F.when(k % 47 != 0, c("client_id")),
        "amount": broken_amount(k),
        "ingest_ts": F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "type": c("trans_type"),
    }
    if dated:
        values["date"] = F.date_format(dated, "yyyy-MM-dd")
    body = [values.get(n, c(n)).alias(n) for n in EVENTS[kind].names]
    document = F.to_json(F.struct(*body))
    sent = facts.select(document.alias("document"), k.alias("key"))
    return sent.select(
        F.when(c("key") % 29 == 0, F.lit("{broken"))
        .when(c("key") % 53 == 0, F.regexp_replace("document", '"account_id":[0-9]+', '"account_id":"none"'))
        .otherwise(c("document"))
        .cast("binary")
        .alias("value")
    )


def scores(star: Star) -> DataFrame:
    """Two scoring runs with a predictable status per loan."""
    loans = star.table("fact_loan", "loan_id", "status")
    guess = F.when(c("loan_id") % 3 == 0, "F").when(c("loan_id") % 3 == 1, "O").otherwise("P")
    again = F.when(c("loan_id") % 3 == 0, "O").when(c("loan_id") % 3 == 1, "O").otherwise("F")
    runs = F.array(
        F.struct(F.lit("run_1").alias("run_id"), F.expr(T1).alias("score_timestamp"), guess.alias("pred_status")),
        F.struct(F.lit("run_2").alias("run_id"), F.expr(T2).alias("score_timestamp"), again.alias("pred_status")),
    )
    return loans.select("loan_id", c("status").alias("actual_status"), F.explode(runs).alias("r")).select(
        "loan_id", "r.score_timestamp", "r.run_id", "actual_status", "r.pred_status"
    )
