"""Table access and staging.

Staging tables are parquet files in the shared folder that the session names in
``spark.checkpoint.dir``; all executors can read them, so a lost executor costs a
re-run of its tasks and nothing else.
"""

from __future__ import annotations

import contextlib
import io
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A folder of our own where the session names none, and only if the session is this one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = f"file://{tempfile.mkdtemp(prefix='notecode-')}"
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")


def _staged(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/staged/{spark.sparkContext.applicationId}"


#: For rows of some MB. Parquet's writer holds a hundred rows before it asks how large they are, and the least and largest
#: value of every row group until the file is closed.
LARGE_ROWS = {"parquet.block.row.count.limit": "1", "parquet.column.statistics.enabled": "false", "parquet.enable.dictionary": "false"}


def stage(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This cuts lineage and fixes values that would differ on a re-run (generated ids);
    columnar and compressed, it is smaller than ``checkpoint()`` and prunes on re-read.
    The folder stays until ``release``.
    """
    spark = df.sparkSession
    path = f"{_staged(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, size: int) -> Iterator[None]:
    """What runs meanwhile sends rows to its Python workers in batches of about ``size`` bytes, a larger row alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def release(spark: SparkSession) -> bool:
    """Delete all that this application has staged. Frames made from it cannot be read after."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staged(spark))
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))


def _share(spark: SparkSession, data: bytes, name: str) -> str:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/files/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    return path.toString()


def ship_file(spark: SparkSession, data: bytes, name: str) -> str:
    """Put a file into the shared folder and on every executor's local disk; ``SparkFiles.get`` of the returned name finds it."""
    name = f"{uuid.uuid4().hex}-{name}"
    spark.sparkContext.addFile(_share(spark, data, name))
    return name


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session's cluster, once per application."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parent.parent
    if not root.is_dir():  # already read from a shipped archive
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    spark.sparkContext.addPyFile(_share(spark, data.getvalue(), f"{root.name}-{uuid.uuid4().hex}.zip"))
    _SHIPPED.add(application)
