"""Session and shared-storage helpers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidewire", cpus: str | int = "*", memory: str = "8g", partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, Arrow)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return (builder.config("spark.checkpoint.dir", shared) if shared else builder).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else one that was set as checkpoint folder. A local session without
    either (tests) gets a temporary one; on a cluster that would be no shared folder, so there it is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not known.isDefined():
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='tidewire-')}")
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
    return known.get()


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage: df as a table written to the shared folder, so it is computed once and survives the loss of executors."""
    at = scratch(df.sparkSession, "cut")
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. Results read it lazily; sweep() removes what a session has made."""
    at = os.path.join(shared_dir(spark), f"tidewire-{name}-{uuid.uuid4().hex}")
    sc = spark.sparkContext
    if not hasattr(sc, "_tidewire_scratch"):
        sc._tidewire_scratch = []
    sc._tidewire_scratch.append(at)
    return at


def sweep(spark: SparkSession) -> None:
    """Deletes the scratch tables of this session; results that were not read yet are lost with them."""
    sc = spark.sparkContext
    while paths := getattr(sc, "_tidewire_scratch", []):
        p = sc._jvm.org.apache.hadoop.fs.Path(paths.pop())
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan (no shuffle below it) that gives fewer tasks than there are cores, as small files of one row group do, is spread over
    all of them before costly Python work. Larger inputs are left as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan._jdf.queryExecution().toRdd().getNumPartitions() < cores else scan


def ship(spark: SparkSession) -> None:
    """Gives the Python workers this package, once per session: a zip of its sources in the shared folder."""
    sc = spark.sparkContext
    if getattr(sc, "_tidewire_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    at = os.path.join(folder, f)
                    z.write(at, os.path.join(os.path.basename(root), os.path.relpath(at, root)))
    path = os.path.join(shared_dir(spark), f"tidewire-package-{uuid.uuid4().hex}.zip")
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(held.getvalue()))
    out.close()
    sc.addPyFile(path)
    sc._tidewire_shipped = True
