"""Where intermediate tables live: the shared folder the cluster names, never a machine-local one."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
_local_folder: dict[str, str] = {}
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # where a stored table lies


def shared_folder(spark: SparkSession) -> str | None:
    """Folder for written intermediate tables.

    ``spark.checkpoint.dir`` decides. Where it is unset, a local master gets one scratch folder of its own (tests);
    a cluster gets None, and ``store`` refuses: a machine-local folder would be seen by one machine only.
    """
    configured = spark.conf.get(SETTING, None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        return None
    if context.applicationId not in _local_folder:
        _local_folder[context.applicationId] = tempfile.mkdtemp(prefix="clientele-")
    return _local_folder[context.applicationId]


def use_for_checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    folder = shared_folder(spark)
    if folder and not spark.conf.get(SETTING, None):
        spark.sparkContext.setCheckpointDir(folder)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    folder = shared_folder(spark)
    if folder is None:
        raise ValueError(f"store: set {SETTING} to a folder that the driver and all executors share")
    return f"{folder.rstrip('/')}/clientele-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to a fresh folder and read it back, so that consumers share one computation.

    The files survive the loss of executors.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    kept = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    _written[kept] = path
    return kept


def store_files(df: DataFrame, name: str, options: dict[str, str]) -> tuple[str, DataFrame]:
    """As ``store``, with options of the file format; the path comes along."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("errorifexists").options(**options).parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def file_state(spark: SparkSession, paths: list[str]) -> str:
    """What changes whenever a file below the paths is added, removed or written: a digest of names, sizes and times.

    Only the listing is read, not the files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length", "modificationTime")
    whole = files.agg(F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")))
    return "-".join(map(str, whole.first()))


def remove(df: DataFrame) -> None:
    """Delete the folder that ``store`` wrote for ``df``, if it did."""
    path = _written.pop(df, None)
    if path is not None:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
