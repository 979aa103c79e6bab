"""Session builder. Sizes are left to the cluster; only plan-shaping flags are set."""

from __future__ import annotations

from pyspark.sql import SparkSession

PLAN_FLAGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime switch from sort-merge to hash joins once every build partition is known to fit.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app: str = "wordloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the flags the plans rely on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in PLAN_FLAGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
