"""Session, table loading and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import io
import os
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)
_SCRATCH: list[str] = []
_SHIPPED: set[str] = set()


def get_session(app: str = "refloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Lists of many small groups stay in hash tables longer before they are sorted instead.
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "10000",
        # Pages and archives go to Python in batches of rows; rows may be large.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse takes its place, which a cluster shares as well.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    named = named or sc.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/refloom_checkpoints"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; ``clear_scratch`` removes all of them."""
    if not _SCRATCH:
        atexit.register(clear_scratch)
    path = f"{shared_dir(spark)}/refloom/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or file of the shared folder, by Spark's own file system access."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch() -> None:
    """Delete what finished queries wrote; called at the end of the driver, or earlier when no result is read any more."""
    spark = SparkSession.getActiveSession()
    while _SCRATCH:
        path = _SCRATCH.pop()
        if spark is not None and spark.sparkContext._jsc is not None:
            remove(spark, path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python steps find it wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(root, __package__)):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(full := os.path.join(folder, name), os.path.relpath(full, root))
    path = scratch_path(spark, "code") + ".zip"
    _SCRATCH[-1] = path
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(packed.getvalue()))
    out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a table just read over all cores when it arrives in a few partitions only (a small or unsplittable file).

    A large table has about as many input partitions as cores, or more, and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 4 * df.rdd.getNumPartitions() <= cores else df


class Tables:
    """Lazy access to the parquet tables of one folder: ``Tables(spark, dir).orders``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))
