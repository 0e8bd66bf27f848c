"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


SETTINGS = {
    # month floors and parsed times are in UTC, like the source data
    "spark.sql.session.timeZone": "UTC",
    # split a skewed join even where an aggregate on the same key follows it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session options the operators count on."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared checkpoint folder.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="caseflow-")
    return f"{base.rstrip('/')}/caseflow-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage before iterative use of ``df``."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
