"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(app_name: str = "tallymark", **settings: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``settings`` win over them.

    Keys are written with ``__`` for dots, e.g. ``spark__sql__shuffle__partitions="8"``.
    """
    builder = SparkSession.builder.appName(app_name)
    chosen = SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose executors share this machine, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallymark-"))
        base = sc.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, so that a lost executor loses nothing.

    Spark deletes it with the DataFrame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    shared_dir(df.sparkSession, "kept")  # a local session without the setting gets a folder of its own
    return df.checkpoint()
