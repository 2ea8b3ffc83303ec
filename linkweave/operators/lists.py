"""Comma lists of ids: exploding, grouping, checking shapes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accepted column names and the ones the engine uses.
ALIASES = {"s1_id": "source1_entity_id", "s1_entity_id": "source1_entity_id", "candidate_id": "candidate_entity_id", "s2_s3_id": "candidate_entity_id"}


def check_columns(df: DataFrame, required: Iterable[str], context: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{context}: missing columns {missing}; has {df.columns}")


def adapt_columns(df: DataFrame) -> DataFrame:
    """Rename known aliases; a name that is already there wins."""
    df = df.withColumnsRenamed({a: b for a, b in ALIASES.items() if a in df.columns and b not in df.columns})
    check_columns(df, ("source1_entity_id", "candidate_entity_id"), "candidates")
    return df


def split_ids(cell: Column) -> Column:
    """Trimmed, non-empty ids in order; null and blank give an empty list."""
    return F.filter(F.transform(F.split(F.coalesce(cell, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def id_set(cell: Column) -> Column:
    return F.array_sort(F.array_distinct(split_ids(cell)))


def explode_ids(df: DataFrame, id_col: str, ids_col: str, value_col: str = "candidate_entity_id") -> DataFrame:
    return df.select(id_col, F.explode(split_ids(F.col(ids_col))).alias(value_col))


def explode_tokens(df: DataFrame, id_col: str, tokens_col: str, *carry: str) -> DataFrame:
    return df.select(id_col, *carry, F.explode(tokens_col).alias("token")).filter("token <> ''")


def group_ids(df: DataFrame, id_col: str, value_col: str, name: str = "ids") -> DataFrame:
    """Sorted distinct ids as a comma string."""
    return df.filter(F.col(value_col).isNotNull()).groupBy(id_col).agg(F.array_join(F.array_sort(F.collect_set(value_col)), ",").alias(name))


def group_ids_by_score(df: DataFrame, id_col: str, value_col: str, score_col: str, name: str = "ids") -> DataFrame:
    """Distinct ids by descending score (then id) as a comma string."""
    best = df.groupBy(id_col, value_col).agg(F.max(score_col).alias("s"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), F.col(value_col).alias("v"))))
    return best.groupBy(id_col).agg(F.array_join(F.transform(ordered, lambda x: x.v), ",").alias(name))


def one_row_each(entities: DataFrame, grouped: DataFrame, id_col: str, name: str) -> DataFrame:
    """Every entity once, with an empty string where it has no group."""
    return entities.select(id_col).distinct().join(grouped, id_col, "left").select(id_col, F.coalesce(name, F.lit("")).alias(name))


def numeric_columns(df: DataFrame, ignore: Iterable[str] = ()) -> list[str]:
    from pyspark.sql.types import NumericType

    skip = set(ignore)
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in skip and not f.name.startswith("_grp_")]


def fill_features(df: DataFrame, columns: Iterable[str], missing: float = -999.0) -> DataFrame:
    """Null and NaN become ``missing``; absent columns are added with it."""
    for c in columns:
        df = df.withColumn(c, F.coalesce(F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")), F.lit(missing)) if c in df.columns else F.lit(missing))
    return df
