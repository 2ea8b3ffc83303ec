"""Tab-separated and Parquet sources, with the text conventions of the data contract.

Every field is a string; nothing is read as missing; quotes are doubled inside quoted fields; an empty
field stays an empty string on the way in and on the way out.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from linkweave.operators.lists import check_columns, explode_ids, one_row_each

ENTITY_COLUMNS = ("entity_id", "business_name", "business_address", "country")
SOURCES = ("source1", "source2", "source3")


class SourceError(ValueError):
    """A file is missing or has the wrong shape."""


def strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Through Hadoop's file system, so that any store counts."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def read_tsv(spark: SparkSession, path: str, required: tuple[str, ...] = (), columns: tuple[str, ...] = ()) -> DataFrame:
    """All columns as strings. With ``columns`` the schema is given and no job runs to find it."""
    if not path_exists(spark, path):
        raise SourceError(f"no such file: {path}")
    reader = spark.read.option("escape", '"').option("sep", "\t").option("header", True)
    try:
        df = (reader.schema(strings(*columns)) if columns else reader).csv(path)
    except AnalysisException as error:
        raise SourceError(f"{path}: {error}") from error
    check_columns(df, required, path)
    return df.fillna("")


def read_sources(spark: SparkSession, folder: str, split: str = "train") -> dict[str, DataFrame]:
    """The three sources of a split."""
    return {s: read_tsv(spark, f"{folder}/{split}_{s}.tsv", ENTITY_COLUMNS, ENTITY_COLUMNS).withColumn("source", F.upper(F.substring("entity_id", 1, 2))) for s in SOURCES}


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth as pairs; singletons have none."""
    return explode_ids(read_tsv(spark, path, ("source1_entity_id", "matched_entity_ids")), "source1_entity_id", "matched_entity_ids")


def read_grouped(spark: SparkSession, path: str, ids_col: str) -> DataFrame:
    """A grouped file as distinct pairs; a missing second field counts as empty."""
    return explode_ids(read_tsv(spark, path, ("source1_entity_id",), ("source1_entity_id", ids_col)), "source1_entity_id", ids_col).distinct()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The first column, stripped, without header, blanks and repeats."""
    lines = spark.read.option("sep", "\t").option("header", True).schema(strings("id")).csv(path)
    return lines.select(F.trim("id").alias("id")).filter("id <> ''").distinct()


def read_targets(spark: SparkSession, folder: str, split: str = "test") -> tuple[DataFrame | None, list[str]]:
    """Ids of S2 and S3, or nothing and a warning when a file is missing."""
    paths = [f"{folder}/{split}_{s}.tsv" for s in SOURCES[1:]]
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        return None, [f"cannot check target ids, missing: {', '.join(missing)}"]
    return read_ids(spark, paths[0]).union(read_ids(spark, paths[1])).distinct(), []


def restrict_truth(truth: DataFrame, s1_ids: DataFrame, universe: DataFrame) -> DataFrame:
    """Truth pairs whose S1 is evaluated and whose candidate exists."""
    return truth.join(s1_ids.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi").join(universe.select(F.col("entity_id").alias("candidate_entity_id")), "candidate_entity_id", "left_semi")


def head_sample(df: DataFrame, n: int, key: str = "entity_id") -> DataFrame:
    """The first ``n`` rows by key, as row order means nothing here."""
    return df.orderBy(key).limit(n)


def with_score(df: DataFrame, column: str = "score") -> DataFrame:
    """A score read as text: what is no number becomes null."""
    return df.withColumn(column, F.expr(f"try_cast({column} as double)"))


def check_prefixes(pairs: DataFrame, column: str, prefixes: tuple[str, ...] = ("S2-", "S3-")) -> None:
    wrong = pairs.filter(~F.col(column).rlike("^(" + "|".join(prefixes) + ")")).select(column).limit(10).collect()
    if wrong:
        raise ValueError(f"{column}: ids without prefix {prefixes}: {[r[0] for r in wrong]}")


def write_tsv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Empty strings are written as nothing between tabs.

    The default is a folder of part files. ``single_file`` gives one file sorted by its first column, as
    the submission format asks for: the last step is one task then, the work before it is not."""
    target = path
    if single_file:
        df, target = df.repartition(1).sortWithinPartitions(df.columns[0]), f"{path}.parts"
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "").option("escape", '"').csv(target)
    if single_file:
        spark = df.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs
        parts, final = hadoop.Path(target), hadoop.Path(path)
        files = parts.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(final, True)
        (part,) = files.globStatus(hadoop.Path(f"{target}/part-*"))
        files.rename(part.getPath(), final)
        files.delete(parts, True)


def grouped_output(s1: DataFrame, pairs: DataFrame, ids_col: str) -> DataFrame:
    """One row per S1 entity with its sorted distinct ids; empty for singletons."""
    check_columns(pairs, ("source1_entity_id", "candidate_entity_id"), ids_col)
    from linkweave.operators.lists import group_ids

    ids = s1.select(F.col("entity_id").alias("source1_entity_id"))
    # as many rows as entities: a repeated id would be lost among them
    n = ids.agg(F.count("*").alias("rows"), F.count_distinct("source1_entity_id").alias("ids")).first()
    if n.rows != n.ids:
        raise SourceError(f"{ids_col}: {n.rows} rows of source 1 have only {n.ids} ids")
    return one_row_each(ids, group_ids(pairs, "source1_entity_id", "candidate_entity_id", ids_col), "source1_entity_id", ids_col)


def write_candidates(s1: DataFrame, pairs: DataFrame, path: str, single_file: bool = False) -> None:
    check_prefixes(pairs, "candidate_entity_id")
    write_tsv(grouped_output(s1, pairs, "candidate_entity_ids"), path, single_file)


def write_matches(s1: DataFrame, pairs: DataFrame, path: str, single_file: bool = False) -> None:
    check_prefixes(pairs, "candidate_entity_id")
    write_tsv(grouped_output(s1, pairs, "matched_entity_ids"), path, single_file)
