"""Session helpers.

The library never creates its own engine: operators take DataFrames.  These helpers
only build a session for tests/benchmarks and resolve the checkpoint folder that
iterative operators use to cut lineage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "tessera") -> SparkSession:
    """Local session for tests and the benchmark (cluster jobs bring their own)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local tests) a private scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: iterative jobs write "
                               "intermediate tables there")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the session's checkpoint folder and read
    it back: one job, columnar on disk, shared storage on a cluster (survives executor
    loss), and the plan that follows starts from the table.  Never a local checkpoint.
    """
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    for paths in _OPEN_SCOPES:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_OPEN_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``cut_lineage`` writes inside the block when it ends.

    For callers that consume a result (write or collect it) before they leave the block;
    frames built inside can't be read after it."""
    paths: list[str] = []
    _OPEN_SCOPES.append(paths)
    try:
        yield
    finally:
        _OPEN_SCOPES.remove(paths)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers (``mapInPandas`` functions refer to
    it): zip the package once per application and add it with ``addPyFile``, the usual
    way to distribute code to executors.  A no-op when already done for this context."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-code-"), "tessera.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
