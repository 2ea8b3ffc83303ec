"""Exact dedup by progressive refinement: length, then a prefix's hash, then the full hash.

Only DataFrame functions. Rows whose byte length no other row has are settled without a look at the
text; of the rest, those whose (length, hash of the first ``prefix_chars`` characters) no other row
has; only for rows that survive both is the whole text hashed. Up to ``broadcast_rows`` surviving ids
(8 bytes each) are sent to the scan, so that no other text is hashed; beyond that bound the hash is
taken in the scan and joined by id, so that texts are never shuffled in either case.

Groups are only ever counted by partial aggregation. The counts are written before they are joined back
to the rows: the other side of each join then has one row per key and no aggregation of its own in the
join's stage, so adaptive execution can split a hot key's rows.

Defined results: null text counts as empty; texts are equal when identical after lower-casing A-Z;
of equal texts the largest id stays; a repeated row (same id, same text) counts in ``group_size`` and
every copy of the row that stays is marked kept; a null id never wins over another id; an empty table
gives an empty result; other columns are ignored by ``exact_dedup`` and kept by ``drop_copies``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.sources.storage import materialise

PREFIX_CHARS = 64
#: Ids of 8 bytes: at most 8 MB go to every executor.
BROADCAST_ROWS = 1 << 20


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row that has an equal other: id, keep_id, group_size."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    light = df.select(F.col(id_col).alias("id"), F.octet_length(text).alias("size"), F.xxhash64(normalised(F.substring(text, 1, prefix_chars))).alias("head"))
    same_size = materialise(light.groupBy("size").count().filter("count > 1").select("size"), "sizes")
    second = light.join(same_size, "size", "left_semi").select("id", F.xxhash64("size", "head").alias("key"))
    same_head = materialise(second.groupBy("key").count().filter("count > 1").select("key"), "heads")
    survivors = materialise(second.join(same_head, "key", "left_semi").select("id").distinct(), "survivors")
    full = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    if survivors.count() <= broadcast_rows:
        hashed = df.join(F.broadcast(survivors), df[id_col].eqNullSafe(survivors["id"]), "left_semi").select(F.col(id_col).alias("id"), full.alias("full"))
    else:
        whole = df.select(F.col(id_col).alias("id"), full.alias("full"))
        hashed = whole.join(survivors.withColumnRenamed("id", "survivor"), F.col("id").eqNullSafe(F.col("survivor")), "left_semi")
    groups = materialise(hashed.groupBy("full").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1"), "groups")
    return hashed.join(groups, "full").select("id", "keep_id", "group_size")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its group and the digest of its normalised text."""
    found = exact_dedup(df, id_col, text_col).distinct().withColumnRenamed("id", "member")
    rows = df.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("text_sha256"))
    out = rows.join(found, F.col("doc_id").eqNullSafe(F.col("member")), "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: a left-anti join with the ids of dropped rows."""
    dropped = exact_dedup(df, id_col, text_col).filter(~F.col("keep_id").eqNullSafe(F.col("id"))).select("id").distinct().withColumnRenamed("id", "__dropped")
    return df.join(dropped, df[id_col].eqNullSafe(dropped["__dropped"]), "left_anti")
