"""The integrity checks of each layer, as DataFrames that a scheduler can read and fail on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ledgerlake.functions.parsing import to_long
from ledgerlake.operators.combine import stack
from ledgerlake.operators.integrity import fact_fk, fk_check, key_pairs, pairs_fk, pk_check
from ledgerlake.sources.colocated import ColocatedGold
from ledgerlake.sources.tables import Gold

c = F.col

# Child, parent and key of each relation between dimensions.
RELATIONS = [
    ("client", "district", "district_id"),
    ("account", "district", "district_id"),
    ("disp", "client", "client_id"),
    ("disp", "account", "account_id"),
    ("card", "disp", "disp_id"),
]


def bronze_fk(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Raw rows whose parent is missing; keys are text and compared as numbers."""

    def key(table: str, name: str):
        return to_long(c("A1" if table == "district" else name))

    return stack(
        [
            fk_check(f"{child}_{parent}", bronze[child], bronze[parent], to_long(c(name)), key(parent, name))
            for child, parent, name in RELATIONS
        ]
    )


def silver_fk(silver: Mapping[str, DataFrame]) -> DataFrame:
    return stack(
        [
            fk_check(f"{child}_{parent}", silver[child], silver[parent], c(key), c(key))
            for child, parent, key in RELATIONS
        ]
    )


def silver_pk(silver: Mapping[str, DataFrame]) -> DataFrame:
    return pk_check(silver["district"], "district_id").select(F.lit("district").alias("table_name"), "*")


def gold_dim_fk(gold: Gold) -> DataFrame:
    """Current children against their parents; a district counts in any version."""
    checks = []
    for child, parent, key in RELATIONS:
        parents = gold.table(f"dim_{parent}", key, "is_current")
        if parent != "district":
            parents = parents.where("is_current")
        rows = gold.table(f"dim_{child}", key, "is_current").where("is_current")
        checks.append(fk_check(f"{child}_{parent}", rows, parents, c(key), c(key)))
    return stack(checks)


def gold_fact_fk(gold: Gold) -> DataFrame:
    """Every fact's account, client and disposition against the rows now in force."""
    keys = {"account": "account_id", "client": "client_id", "disp": "disp_id"}
    parents = {n: (gold.table(f"dim_{n}", key, "is_current").where("is_current"), key) for n, key in keys.items()}
    facts = ["fact_loan", "fact_order", "fact_trans"]
    if not isinstance(gold, ColocatedGold):
        return stack([fact_fk(name, gold.table(name, *keys.values()), parents) for name in facts])
    # Rows of a client lie together: they are counted where they are, only the counts are exchanged, and the parents once for all facts.
    pairs = []
    for name in facts:
        for df in gold.parts(name, *keys.values()):
            pairs.append(key_pairs(name, df.groupBy(*keys.values()).agg(F.count("*").alias("weight")), keys))
    return pairs_fk(stack(pairs), parents, [f"{name}_{p}" for name in facts for p in keys])
