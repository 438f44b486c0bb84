"""Session helpers: build a session for local runs and resolve the
checkpoint folder from the cluster configuration."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "crawlmeta") -> SparkSession:
    """Session for tests and the bench (local mode). On a cluster use the
    session the platform gives you; every transform here is session-agnostic."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CRAWLMETA_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session. Only a local-mode session without the setting (tests, the bench)
    gets a fresh folder of its own; a cluster session without it is an error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so that checkpoints survive executor loss")
    folder = tempfile.mkdtemp(prefix="crawlmeta-ckpt-", dir="/tmp")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder. It goes when the
    driver's JVM ends: results that read it are lazy."""
    import uuid

    path = f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return path


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def dealt_listing(spark: SparkSession) -> Iterator[None]:
    """Reads of tables with many folders that are made inside list the folders
    by as many tasks as the cluster has places for. Spark's own number is a task
    per folder, up to 10,000, each of which takes longer to start than to run."""
    before = int(spark.conf.get(_LISTING))
    spark.conf.set(_LISTING, min(before, 4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_rows(spark: SparkSession, columns: list[str], rows: list[tuple], schema: str | None = None):
    """A small fixed table as a SQL ``VALUES`` local relation (JVM-side, no
    Python RDD, known size for broadcast planning)."""
    if not rows:
        return spark.createDataFrame([], schema or ", ".join(f"{c} string" for c in columns))
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")
    if schema:
        from pyspark.sql import functions as F
        types = [x.strip().split(" ", 1) for x in schema.split(",")]
        df = df.select(*[F.col(n).cast(t).alias(n) for n, t in types])
    return df


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``crawlmeta`` importable by the Python workers (UDFs, data
    sources, ``mapInPandas``): the package is zipped once per SparkContext
    and added with ``addPyFile``, which Spark distributes to every executor
    (the same as ``--py-files``). Skipped when ``spark.submit.pyFiles``
    already carries it."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    if "crawlmeta" not in (sc.getConf().get("spark.submit.pyFiles", "") or ""):
        import crawlmeta
        pkg = os.path.dirname(os.path.abspath(crawlmeta.__file__))
        root = os.path.dirname(pkg)
        path = os.path.join(tempfile.mkdtemp(prefix="crawlmeta-pyfiles-"), "crawlmeta.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for dirpath, _dirs, files in os.walk(pkg):
                for f in files:
                    if f.endswith(".py"):
                        full = os.path.join(dirpath, f)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(path)
    _SHIPPED.add(key)
