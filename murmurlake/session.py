"""Session helpers: a default local session and lineage cuts that survive lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("murmurlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Where the setting is absent a folder of this machine is used, but only with a
    local master: on a cluster other executors couldn't read it, so that raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIR:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _OWN_DIR[app] = tempfile.mkdtemp(prefix="murmurlake-")
        atexit.register(shutil.rmtree, _OWN_DIR[app], ignore_errors=True)
    return _OWN_DIR[app]


def cut_folder(spark: SparkSession) -> str:
    """Where this application's cut tables lie; other applications that share the folder have their own."""
    return f"{shared_dir(spark)}/murmurlake/{spark.sparkContext.applicationId}"


def cut(df: DataFrame, name: str = "cut", partition_by: list[str] | None = None, replaces: DataFrame | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table into the shared folder and read it back.

    Later stages then depend on files, not on executors: neither a lost executor nor
    a second action repeats the work before the cut. ``replaces`` is an earlier cut that is
    no longer read, say the last round of an iteration; it is deleted once the new one is there.
    """
    spark = df.sparkSession
    path = f"{cut_folder(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    _PATHS[id(out)] = (weakref.ref(out, lambda _, key=id(out): _PATHS.pop(key, None)), path)
    if replaces is not None and id(replaces) in _PATHS:
        _delete(spark, _PATHS[id(replaces)][1])
    return out


_PATHS: dict[int, tuple[weakref.ref, str]] = {}


def _delete(spark: SparkSession, path: str, recursive: bool = True) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, recursive)


def clear_cuts(spark: SparkSession) -> None:
    """Delete the tables that ``cut`` has written in this application; call it once no result is read any more."""
    _delete(spark, cut_folder(spark))
    above = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/murmurlake")
    files = above.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(above) and not len(files.listStatus(above)):
        files.delete(above, False)
