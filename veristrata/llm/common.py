"""What the operators share: the shared folder, written tables, word rules and readers."""

from __future__ import annotations

import atexit
import ctypes
import io
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of characters that are neither a blank nor \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
REPO = str(Path(__file__).resolve().parents[2])
#: Rows of an Arrow batch: texts may be long, so batches are kept short.
BATCH_ROWS = "1000"

_written: list[str] = []
_shipped: set[str] = set()


def _is_local(spark: SparkSession) -> bool:
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def prepare(spark: SparkSession) -> SparkSession:
    """Set what every operator with Python code needs: the package on the workers and short
    Arrow batches. On a cluster the package is shipped as an archive, once an application."""
    sc = spark.sparkContext
    if _is_local(spark):
        paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
        if REPO not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [REPO])
    elif sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        sc.addPyFile(_archive(spark))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def _archive(spark: SparkSession) -> str:
    """The package's modules as an archive in the shared folder."""
    data = io.BytesIO()
    package = Path(__file__).resolve().parents[1]
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent).as_posix())
    path = f"{new_path(spark, 'package')}.zip"
    _written.append(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(data.getvalue()))
    out.close()
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir. Where that is unset, a temporary one with a
    local master, and an error on a cluster, whose machines share no temporary folder."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.veristrata.shared", None)
    if not found:
        if not _is_local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="veristrata-")
        spark.conf.set("spark.veristrata.shared", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    if not _written:
        atexit.register(_sweep, spark)
    _written.append(path)
    return path


def materialise(df: DataFrame, tag: str, **options: str) -> DataFrame:
    """Cut the lineage: write df as a table in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, tag)
    df.write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._veristrata_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        path = getattr(t, "_veristrata_path", None)
        if path in _written:
            _delete(t.sparkSession, path)
            _written.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _sweep(spark: SparkSession) -> None:
    try:
        for path in _written:
            _delete(spark, path)
    except Exception:  # the JVM may be gone at exit; the folder is then the cluster's to clean
        return


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    blank = "[\\x20\\x09-\\x0D]"
    n = F.size(F.split(text, SPACE)) - text.rlike(f"^{blank}").cast("int") - text.rlike(f"{blank}\\z").cast("int")
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0)).otherwise(n).cast("long")


def utf8(text: Column) -> Column:
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def give_back() -> None:
    """Return freed memory to the system, as Python workers outlive their tasks."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        return
