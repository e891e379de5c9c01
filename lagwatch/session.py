"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def get_session(app: str = "lagwatch", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings every operator assumes (UTC, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session; partition counts stay the cluster's."""
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # windows cost much per byte: keep small shuffles on all cores; large ones are not affected
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128KB")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Functions that run there are pickled by reference to their module, so a worker must be able to
    import it wherever the driver was started.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="lagwatch-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent and the master is local, a temporary folder is taken once and
    recorded in the session, so that every later call sees the same place. On a cluster the
    setting is needed: executors do not share their local folders.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="lagwatch-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), "lagwatch", f"{name}-{uuid.uuid4().hex}")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read the same intermediate table (the message topics of the
    original topology): the upstream work runs once, the lineage is cut, and every branch
    still gets column pruning and filter pushdown on its scan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
