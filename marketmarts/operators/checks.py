"""Table rules as queries: NOT NULL, primary/unique keys, foreign keys, taxonomy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, TABLE_RULES, checked_columns


def not_null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, n_nulls) for every required column and every time; one scan per table."""
    parts = []
    for name, df in tables.items():
        req = [c for c in checked_columns(name) if c in df.columns]
        if not req:
            continue
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in req])
        stacked = counts.select(
            F.explode(
                F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_nulls")) for c in req])
            ).alias("s")
        )
        parts.append(stacked.select(F.lit(name).alias("table_name"), "s.column_name", "s.n_nulls"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, key_name, n_rows, n_keys, n_duplicate_keys) per primary/unique key."""
    parts = []
    for name, df in tables.items():
        rule = TABLE_RULES[name]
        keys = [rule["key"]] + rule.get("unique", [])
        for key in keys:
            if not all(k in df.columns for k in key):
                continue
            per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
            parts.append(
                per_key.agg(
                    F.sum("_n").alias("n_rows"),
                    F.count(F.lit(1)).alias("n_keys"),
                    F.count_if(F.col("_n") > 1).alias("n_duplicate_keys"),
                ).select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("key_name"), "*")
            )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def orphans(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str) -> DataFrame:
    """Child rows whose (non-NULL) foreign key has no parent row."""
    p = parent.select(F.col(parent_col).alias("_pk"))
    return child.filter(F.col(child_col).isNotNull()).join(p, F.col(child_col) == F.col("_pk"), "left_anti")


def orphan_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(child_table, parent_table, n_orphans) for every declared foreign key."""
    parts = []
    for child, ccol, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            n = orphans(tables[child], tables[parent], ccol, pcol).agg(F.count(F.lit(1)).alias("n_orphans"))
            parts.append(n.select(F.lit(child).alias("child_table"), F.lit(parent).alias("parent_table"), "n_orphans"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def taxonomy_violations(taxonomy: DataFrame) -> DataFrame:
    """Surfaces mapped to more than one skill (must be empty)."""
    return (
        taxonomy.groupBy("surface")
        .agg(F.countDistinct("skill").alias("n_skills"))
        .filter(F.col("n_skills") > 1)
    )

