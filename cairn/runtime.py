"""Session helpers: local sessions, the shared checkpoint folder, shipping the package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benches; clusters bring their own."""
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    builder = SparkSession.builder.master(f"local[{cores}]").appName("cairn")
    for key, value in base.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only a local session may have none; it gets a temporary one."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = found.get() if found.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cairn-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        where = "file://" + folder
        spark.sparkContext.setCheckpointDir(where)
    return where


_SCRATCH: dict[str, SparkSession] = {}


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder, for this application only: what is there when Python ends is removed."""
    app = f"{shared_dir(spark)}/cairn/{spark.sparkContext.applicationId}"
    if app not in _SCRATCH:
        _SCRATCH[app] = spark
        atexit.register(_remove, spark, app)
    return f"{app}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(where, True)
    except Exception:  # the JVM has gone: nothing can be removed any more
        pass


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df below the shared folder and reads it back: lineage is cut and survives the loss of executors.

    It runs at once, also where the caller only builds a plan. ``discard`` removes the table early.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``materialise`` made and that no plan to come reads."""
    for t in tables:
        _remove(t.sparkSession, t.scratch)


def filesystem(spark: SparkSession, path: str):
    """(file system of a path, what makes a path of it)."""
    to = spark._jvm.org.apache.hadoop.fs.Path
    return to(path).getFileSystem(spark._jsc.hadoopConfiguration()), to


def read_text(spark: SparkSession, path: str) -> str:
    fs, to = filesystem(spark, path)
    stream = fs.open(to(path))
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole and never replaces another: FileExistsError if there is one already.

    It is written under another name and renamed without overwriting, which the file system must do atomically.
    """
    fs, to = filesystem(spark, path)
    folder, name = path.rsplit("/", 1)
    temp = to(f"{folder}/.{name}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temp, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    try:
        context.rename(temp, to(path), options)
    except Exception as err:
        fs.delete(temp, False)
        if "FileAlreadyExistsException" in str(err):
            raise FileExistsError(path) from err
        raise


def numbered(spark: SparkSession, folder: str) -> list[int]:
    """The numbers that files of a folder are called (with or without .json), ascending: one listing, nothing is read."""
    fs, to = filesystem(spark, folder)
    if not fs.exists(to(folder)):
        return []
    names = [f.getPath().getName().removesuffix(".json") for f in fs.listStatus(to(folder))]
    return sorted(int(n) for n in names if n.isdigit())


def spread(df: DataFrame) -> DataFrame:
    """A narrow plan over fewer splits than there are cores, as over one small file, gets a partition per core; any other stays as it is.

    Call it on a plain scan with the columns already chosen, right before Python: what is planned here is
    only the scan's splits, no job runs. Large tables always have more splits than cores.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if "Exchange" in plan.toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if plan.execute().getNumPartitions() >= cores else df.repartition(cores)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application, as they may not have it installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="cairn-ship-")  # the driver's own: it serves the file as long as it runs
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "cairn.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)
