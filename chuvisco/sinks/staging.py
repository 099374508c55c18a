"""Working copies on the folder the cluster shares."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


#: Setting of a session that names a shared folder where ``spark.checkpoint.dir`` does not.
WORK_FOLDER = "spark.chuvisco.workFolder"
#: Codec of Parquet files: they take less disk than by Spark's default.
COMPRESSION = "zstd"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, which every executor can reach.

    A session without that setting must name one under ``WORK_FOLDER``, as tests do, or is refused. What is written there is
    removed by :func:`release`, or when the session's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_FOLDER, None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = f"{root.rstrip('/')}/work-{uuid4().hex}"
    files, path = _file_system(spark, folder)
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, on whatever file system it names."""
    files, location = _file_system(spark, path)
    return files.exists(location)


def release(spark: SparkSession, path: str) -> None:
    """Remove the working folder that holds ``path``, which :func:`work_path` gave."""
    remove_path(spark, path.rsplit("/", 1)[0])


def remove_path(spark: SparkSession, path: str) -> None:
    files, location = _file_system(spark, path)
    files.delete(location, True)


def remove_file(spark: SparkSession, address: str) -> bool:
    """Remove the file at an encoded address, as ``_metadata.file_path`` gives it; whether it is gone."""
    location = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(address))
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(location, False)
    return not files.exists(location)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a reader finds a file anywhere below ``path``; the listing ends at the first one."""
    files, location = _file_system(spark, path)
    if not files.exists(location):
        return False
    listed = files.listFiles(location, True)
    while listed.hasNext():
        if not listed.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def move_path(spark: SparkSession, path: str, to: str) -> None:
    files, location = _file_system(spark, path)
    if not files.rename(location, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} cannot be moved to {to}")


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """Write ``df`` as Parquet to a working path and read it back.

    The result no longer depends on the inputs of ``df``, so a path those inputs came from can be
    overwritten, and a lost executor costs a file read instead of a recomputation.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
