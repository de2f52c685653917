"""Where intermediate tables go: a folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession


def _base(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder in the session's warehouse.

    A warehouse on the driver's own disk is no place that executors share, so it is refused unless they run in the driver's process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        _, store = _store(spark, base)
        if store.getScheme() == "file" and not _one_process(spark.sparkContext.master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share; {base} is on one machine")
        base = base.rstrip("/") + "/polysift-scratch"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def _one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for the session's intermediate tables."""
    return f"{_base(spark)}/{name}-{uuid.uuid4().hex}"


#: Codecs of tables, by name, that hold a row or more for each of the input's; others have Spark's default.
CODECS = {"tokenized": "zstd", "unordered": "zstd", "ordered": "zstd"}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=CODECS.get(name))
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing will read again, and let Spark drop the shuffle files behind them.

    Spark deletes shuffle files once the driver has collected the plans that made them; a job of many steps would
    otherwise keep those of all its steps on the executors' disks.
    """
    if tables:
        discard_folder(tables[0].sparkSession, *[table._scratch_path for table in tables])


def discard_folder(spark: SparkSession, *paths: str) -> None:
    """:func:`discard` for folders that a job wrote itself."""
    for path in paths:
        delete(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _store(spark: SparkSession, folder: str):
    """Hadoop's path and file system of a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store."""
    path, store = _store(spark, folder)
    store.delete(path, True)


def exists(spark: SparkSession, path: str) -> bool:
    path, store = _store(spark, path)
    return store.exists(path)


def children(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Names in a folder of the shared store that begin so; none where it does not exist."""
    path, store = _store(spark, folder)
    found = store.listStatus(path) if store.exists(path) else []
    return sorted(f.getPath().getName() for f in found if f.getPath().getName().startswith(prefix))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file of the shared store."""
    path, store = _store(spark, source)
    if not store.rename(path, _store(spark, target)[0]):
        raise OSError(f"{source} could not become {target}")


def touch(spark: SparkSession, path: str) -> None:
    """Make an empty file."""
    path, store = _store(spark, path)
    store.create(path, True).close()


def clear(spark: SparkSession) -> None:
    """Delete the session's intermediate tables; results that read them must be written before."""
    delete(spark, _base(spark))
