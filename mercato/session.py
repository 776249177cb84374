"""Session construction and the shared folder of written tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Session settings the operators rely on. AQE re-plans joins at runtime:
# a join side only becomes a broadcast when its measured size is below
# spark.sql.autoBroadcastJoinThreshold, and skewed shuffle partitions are
# split by the skew-join rule.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "mercato",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only meant for local runs and tests; on a cluster the
    launcher sets it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """Folder shared by all executors for checkpoints and written tables: the
    session's ``spark.checkpoint.dir``. None where it is unset; nothing is
    written then."""
    return spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or None


def session_key(spark: SparkSession) -> str:
    """Tells apart the sessions of one application."""
    return f"{spark.sparkContext.applicationId}/{spark._jsparkSession.sessionUUID()}"
