"""Session factory and the few settings every operator relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that keep plans adaptive; sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    conf = DEFAULTS | {"spark.sql.shuffle.partitions": str(partitions), "spark.driver.memory": memory} | extra
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("millrace")
    return builder.config(map=conf).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset, a local one is set here, but only if all executors are on this machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            at = current.get()
        elif spark.sparkContext.master.startswith("local"):
            at = "file://" + tempfile.mkdtemp(prefix="millrace-")
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """Cuts lineage through a reliable checkpoint in the shared folder, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once a session, so that they need no copy of it."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    _SHIPPED.add(spark.sparkContext.applicationId)
    package = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="millrace-py-"), "millrace.zip")  # the driver hands it out from there
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(at)


_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fresh(spark: SparkSession) -> str:
    """The URI of a new folder within the shared one; removed at exit."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}")
    at = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    atexit.register(_remove, spark, at)
    return at


def keep(df: DataFrame, at: str | None = None) -> DataFrame:
    """Cuts lineage through a written table in the shared folder (at: one of its fresh folders): columnar and compressed, so smaller than a checkpoint. Removed at exit."""
    spark, at = df.sparkSession, at or fresh(df.sparkSession)
    df.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def _remove(spark: SparkSession, at: str) -> None:
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may have ended already  # noqa: BLE001
        pass
