"""Session settings shared by tests, benchmarks and applications."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Adaptive execution re-plans joins and splits skewed partitions at run time.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "paperloom", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session; on a cluster use ``apply_defaults`` on the session that submit created."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on a session made elsewhere."""
    for key, value in DEFAULTS.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    return spark
