"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE re-plans joins from runtime sizes (broadcast only when measured small),
# coalesces small shuffle partitions and splits skewed join partitions.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(master: str | None = None, app_name: str = "dossier",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Builds (or returns) a session with the settings above and the UI off."""
    b = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``. Only when the
    cluster names none (local tests) is ``fallback`` set and used."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir() if hasattr(spark.sparkContext, "getCheckpointDir") else None
    if not d and fallback:
        spark.sparkContext.setCheckpointDir(fallback)
        d = fallback
    return d
