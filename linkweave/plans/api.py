"""The engine as functions over raw source frames, for callers that have their own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.functions.normalize import normalise
from linkweave.operators import blocking, features
from linkweave.operators.lists import adapt_columns
from linkweave.sources.storage import materialise

NAMES = ("entity_id", "business_name", "business_address", "country")


def prepare(df: DataFrame, source: str, columns: dict[str, str] | None = None, scripts: str = "all") -> DataFrame:
    """A raw source, its columns named as in ``NAMES`` (``columns`` maps ours to the caller's), normalised once."""
    own = {n: (columns or {}).get(n, n) for n in NAMES}
    named = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in own.items()], F.lit(source).alias("source"))
    return materialise(normalise(named, scripts=scripts), source.lower())


def _both(s2: DataFrame, s3: DataFrame, columns, scripts) -> DataFrame:
    return prepare(s2, "S2", columns, scripts).unionByName(prepare(s3, "S3", columns, scripts))


def generate_candidates(s1: DataFrame, s2: DataFrame, s3: DataFrame, *, columns: dict[str, str] | None = None, k: int = blocking.TOP_K, scripts: str = "all", **caps) -> DataFrame:
    """source1_entity_id, candidate_entity_id, signal, score."""
    return blocking.generate_candidates(prepare(s1, "S1", columns, scripts), _both(s2, s3, columns, scripts), k, **caps)


def build_features(candidates: DataFrame, s1: DataFrame, s2: DataFrame, s3: DataFrame, *, columns: dict[str, str] | None = None, scripts: str = "all") -> DataFrame:
    """The candidates with the twelve features; other columns of ``candidates`` are kept."""
    return features.build_features(adapt_columns(candidates), prepare(s1, "S1", columns, scripts), _both(s2, s3, columns, scripts))
