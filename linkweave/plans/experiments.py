"""An append-only log of experiments, one JSON-free CSV row each."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from linkweave.sources.tables import path_exists, strings

# Fixed values of the data contract: the columns, and the digits that figures are kept with (none: as given).
COLUMNS = "experiment_id string, timestamp string, blocking_version string, feature_version string, model_version string, threshold double, rel_margin double, macro_f05 double, singleton_acc double, non_singleton_f05 double, leaderboard_score double, notes string"
DIGITS = {"threshold": 4, "rel_margin": 4, "macro_f05": 4, "singleton_acc": 4, "non_singleton_f05": 4}
FIELDS = tuple(c.split()[0] for c in COLUMNS.split(", "))


def log_experiment(spark: SparkSession, path: str, **run) -> str:
    """Append a run, given by columns (absent ones are blank), to the folder and return its id. The clock is
    Spark's; figures are formatted by one projection over the typed row."""
    unknown = run.keys() - set(FIELDS)
    if unknown:
        raise ValueError(f"the log has no columns {sorted(unknown)}")
    typed = StructType.fromDDL(COLUMNS)
    values = {"experiment_id": uuid.uuid4().hex[:8], **run}
    row = [float(v) if isinstance(f.dataType, DoubleType) and v is not None else v for f in typed for v in [values.get(f.name)]]
    one = spark.createDataFrame([row], typed).withColumn("timestamp", F.coalesce("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")))
    shown = [F.coalesce((F.round(c, DIGITS[c]) if c in DIGITS else F.col(c)).cast("string"), F.lit("")).alias(c) for c in FIELDS]
    one.select(shown).coalesce(1).write.mode("append").option("header", True).option("emptyValue", "").csv(path)
    return values["experiment_id"]


def load_experiments(spark: SparkSession, path: str) -> DataFrame:
    """All rows; none if there is no log yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], strings(*FIELDS))
    return spark.read.schema(strings(*FIELDS)).option("header", True).csv(path).fillna("")


def best_experiment(log: DataFrame, metric: str = "macro_f05") -> DataFrame:
    """The row with the highest metric, blanks ignored; the earliest of equals."""
    value = F.expr(f"try_cast({metric} as double)")
    return log.filter(value.isNotNull()).orderBy(value.desc(), "timestamp", "experiment_id").limit(1)
