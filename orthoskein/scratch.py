"""Intermediate tables in the folder that all executors share.

Lineage is cut by writing a table below ``spark.checkpoint.dir`` and reading it
again; a lost executor then costs a task, not a chain of stages.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    ``spark.checkpoint.dir`` is taken from the session. Where it is unset, a
    local master gets a temporary folder and a cluster the warehouse folder.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if spark.sparkContext.master.startswith("local["):
                base = "file://" + tempfile.mkdtemp(prefix="scratch-")
            else:
                base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        _ROOTS[app] = f"{base.rstrip('/')}/{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_forget, spark, app)
    return _ROOTS[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the scratch folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path  # type: ignore[attr-defined]
    return out


def unstash(df: DataFrame | None) -> None:
    """Delete a stash that no later plan reads."""
    path = getattr(df, "_stash_path", None)
    if path:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` scans; 0 where the sources tell none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _forget(spark: SparkSession, app: str) -> None:
    try:
        delete(spark, _ROOTS.pop(app))
    except Exception:  # noqa: BLE001 - the JVM may be gone already at exit
        pass
