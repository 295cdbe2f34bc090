"""What the operators share: cutting lineage into shared storage, and joins whose broadcast side has a checked size."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side with at most so many rows is broadcast; a larger one is shuffled. Rows are slim (keys and counts).
BROADCAST_ROWS = 300_000

_own_dirs: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a folder of our own only where that is unset (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="corpusmill-")
    return _own_dirs[app]


def _forget(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:
        if path.startswith("file://"):
            import shutil

            shutil.rmtree(path[7:], ignore_errors=True)


def materialize(df: DataFrame, *, partition_rows: int | None = None) -> DataFrame:
    """Write df once into shared storage and read it back: lineage ends there, sizes are known, and a lost executor costs no recomputation.

    Columns are pruned on reading, so a wide intermediate can be read again for one column. The files go when the session ends, or by `forget`.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_rows:
        writer = writer.option("maxRecordsPerFile", partition_rows)
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def forget(spark: SparkSession, keep: int = 0) -> None:
    """Delete the session's intermediate tables but the first `keep`: for long sessions, once their results are written."""
    paths = _written.get(spark.sparkContext.applicationId, [])
    for path in paths[keep:]:
        _forget(spark, path)
    del paths[keep:]


@atexit.register
def _forget_all() -> None:
    import shutil

    spark = SparkSession.getActiveSession()
    if spark is not None:
        forget(spark)
    for path in _own_dirs.values():
        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def sized(df: DataFrame, rows: int | None = None, bound: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it holds at most `bound` rows, else with a shuffle-hash hint. df should be materialized."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= bound else df.hint("shuffle_hash")


def cores(spark: SparkSession) -> int:
    return max(2, spark.sparkContext.defaultParallelism)


def env_path(name: str, default: str) -> str:
    return os.environ.get(name, default)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application; a cluster need not have it installed."""
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="corpusmill-ship-")) / "corpusmill.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    context.addPyFile(str(target))
    _shipped.add(context.applicationId)


def shipped(query):  # noqa: ANN001, ANN201
    """A query that first ships the package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run
