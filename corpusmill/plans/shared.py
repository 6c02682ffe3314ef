"""Session defaults and intermediate tables that outlive an executor."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "corpusmill", cores: int | None = None, **conf: str) -> SparkSession:
    """A session with the defaults that the operators are tuned for; settings given in ``conf`` win."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(name)
    if cores:
        builder = builder.master(f"local[{cores}]")
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Folders made for sessions of one process that name none, by application.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only where the session has none and runs in one process, as in tests, a folder of this machine is made.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="corpusmill-")
    return _own[app]


#: Tables written by this process, by application.
_written: dict[str, list[str]] = {}


def clear(spark: SparkSession) -> int:
    """Removes the tables that ``materialize`` wrote for this application, once their results are no longer read."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    return len(paths)


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as a table into the shared folder and read it back: the lineage ends there. ``by`` names a column of
    few values to partition the files by.

    For results that are read more than once or that Python made at some cost. The files survive the loss of any
    executor, and stay until ``clear``, as the DataFrame may be read at any time.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    writer = df.write.mode("error").option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` in ``folder``, in as many partitions as there are cores at least."""
    return busy(spark.read.parquet(f"{folder}/{name}.parquet"))


def busy(scan: DataFrame, least: int = 1 << 20, part: int = 1 << 18) -> DataFrame:
    """A scan that would leave cores idle, such as one of a single row group, in more partitions; others as they are.

    Files of at least ``least`` bytes in fewer partitions than cores are dealt out in parts of about ``part`` bytes. That is a shuffle of
    a few megabytes a core at most; a large table has more partitions than cores and is never shuffled here.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < least or size > (cores << 27) or scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(max(1, min(cores, size // part)))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: its source goes to them as a zip file, once a SparkContext."""
    sc = spark.sparkContext
    if getattr(sc, "_corpusmill_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="corpusmill-zip-")  # read by the driver only, which serves the file
    name = os.path.join(folder, "corpusmill_src.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(at, f)
                    z.write(path, os.path.join("corpusmill", os.path.relpath(path, root)))
    sc.addPyFile(name)
    sc._corpusmill_shipped = True
