"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for these jobs; a cluster's own values for sizes and partition counts win.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, app: str = "ledgerloom", **conf: str) -> SparkSession:
    """A session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = DEFAULTS | {"spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "16g"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only where none is named (tests)."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="ledgerloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder
