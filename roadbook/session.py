"""Session settings shared by the jobs, the tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs want; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # call sites in error messages cost the driver a round trip per expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, where cut lineages are stored.

    A session of one machine (``local`` and ``local[n]``, as in tests) may do
    without the setting and gets a folder beside its warehouse; any other is refused.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
