"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Settings every job relies on for speed, none for correct results.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Wide rows (38 cells parsed and cleaned) generate methods beyond the 8000 bytes the JVM compiles; such
    # stages run twice as fast when they are split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Call sites of every column expression cost more than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "obslake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)  # the jobs fit forecasts in Python workers, which need not have the package
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they need not have it installed.

    The archive is kept beside the session's context, so that calling this again costs nothing.
    """
    sc = spark.sparkContext
    if getattr(sc, "_obslake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="obslake-package-"), "obslake_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._obslake_shipped = True


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A few configured rows as a frame of literals, which the optimiser sees and no Python worker reads."""
    structs = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields, strict=True)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever chosen for a local session: on a cluster an executor that is
    lost would take its part of the data with it, so the setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    current = spark.sparkContext.getCheckpointDir()
    return current or tempfile.mkdtemp(prefix="obslake-")


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/obslake-{label}-{uuid.uuid4().hex}"


#: Deletes what a query has shuffled when it ends. Otherwise it lies on the executors' disks until the driver's heap happens to be collected.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared folder, partitions and row order kept; what was shuffled for it is deleted."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    before = spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        return df.select("*").checkpoint()  # a new plan: the setting holds for plans made under it
    finally:
        if before is None:
            spark.conf.unset(_RELEASE)
        else:
            spark.conf.set(_RELEASE, before)
