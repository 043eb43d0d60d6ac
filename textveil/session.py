"""Session construction and the shared folder for cut lineage."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for (UTC, AQE)."""
    b = (
        SparkSession.builder.master(master)
        .appName("textveil")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no search of the Python stack at every Column that is made
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors (as a zip on their path), once per session.

    Needed where it is not installed there, as Python operators run in their processes.
    """
    sc = spark.sparkContext
    if getattr(sc, "_textveil_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "textveil.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    sc._textveil_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none (as in tests on one machine) a folder of
    our own is set, once per session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    set_already = spark.sparkContext.getCheckpointDir()
    if set_already:
        return set_already
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("name a folder all executors share in spark.checkpoint.dir")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textveil-"))
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, for files of this session."""
    return f"{shared_dir(spark).removeprefix('file:')}/{name}-{uuid.uuid4().hex}"


_CUTS: list[str] = []


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, but columnar and compressed; the files
    survive the loss of any executor.  They are there until :func:`drop_cuts` is
    called, or the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _CUTS:
        atexit.register(_drop_at_exit)
    _CUTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(spark: SparkSession) -> int:
    """Delete the tables that :func:`cut` wrote, once the results made from them are
    written; answers their number."""
    n = len(_CUTS)
    jvm = spark.sparkContext._jvm
    while _CUTS:
        path = jvm.org.apache.hadoop.fs.Path(_CUTS.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _CUTS:
        try:
            drop_cuts(spark)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            pass
