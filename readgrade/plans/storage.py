"""Intermediate tables in the shared folder that the cluster names."""

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without that setting gets a folder of its own.

    The session's settings are left alone.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="readgrade-")
        folder = _own[app]
    return folder.rstrip("/")


def _home(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/readgrade/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{_home(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: the lineage ends in files that outlive any executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialise` returned, once all that is built on them is stored itself."""
    for table in tables:
        _delete(table.sparkSession, _paths.pop(table))


def release(spark: SparkSession) -> None:
    """Delete all that this application has stored; tables read from it are gone."""
    _delete(spark, _home(spark))
