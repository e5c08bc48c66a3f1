"""Session settings, and the shared folder used for checkpoints and hand-off tables."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: int = 8, app: str = "civicframe", shared: str | None = None) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own. ``shared`` names the folder for hand-off tables."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="civicframe-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return path


_FOLDERS: list[str] = []  # of the open ``stages`` blocks, the innermost last


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a hand-off table: in the folder of the open ``stages`` block, else in the shared folder."""
    folder = _FOLDERS[-1] if _FOLDERS else shared_dir(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def stages(spark: SparkSession, folder: str | None = None):
    """Hand-off tables made inside the block go into a folder of their own below ``folder`` (default: the shared
    folder) and are removed at its end. Write or collect the results inside the block.
    """
    own = f"{(folder or shared_dir(spark)).rstrip('/')}/run-{uuid.uuid4().hex}"
    _FOLDERS.append(own)
    try:
        yield own
    finally:
        _FOLDERS.remove(own)
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage: write the rows to a Parquet table in the shared folder and read them back.

    The table survives the loss of executors, and later steps can prune its columns.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialise_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """Like :func:`materialise`, with aggregate metrics taken while the rows are written."""
    seen = Observation(uuid.uuid4().hex)
    table = materialise(df.observe(seen, *[c.alias(k) for k, c in metrics.items()]))
    return table, seen.get


def bucket_of(buckets: int, *keys: str) -> Column:
    """The bucket that Spark's bucketed tables give a row."""
    return F.pmod(F.hash(*keys), F.lit(buckets))


class Bucketed:
    """Rows written once as a table in the shared folder, bucketed by ``keys``: joins and groups on the keys read it without
    an exchange. With ``within``, a whole number from 0, each of its values has buckets of its own: rows of one value read and join by
    the keys alone. With ``dealt``, the rows of a bucket already lie in one task (:func:`bucket_of` names it). ``with Bucketed(...) as df``
    drops the table's name at the end; the files go with the other hand-off tables.
    """

    def __init__(self, df: DataFrame, *keys: str, buckets: int | None = None, within: str | None = None, dealt: bool = False):
        spark, n = df.sparkSession, buckets or shuffle_width(df.sparkSession)
        self.spark, self.name = spark, f"bucketed_{uuid.uuid4().hex}"
        path = scratch_path(spark, "bucketed")
        if within is None:
            rows, write = df if dealt else df.repartition(n, *keys), lambda rows: rows.write
        else:  # as many tasks as there are shuffle partitions; a bucket of a value is written by one of them
            rows = df if dealt else df.repartition(shuffle_width(spark), F.col(within), bucket_of(n, *keys))
            write = lambda rows: rows.write.partitionBy(within)
        write(rows).bucketBy(n, *keys).option("path", path).format("parquet").saveAsTable(self.name)

    def __enter__(self) -> DataFrame:
        return self.spark.table(self.name)

    def __exit__(self, *error) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out to all cores when the input has fewer splits than half of them.

    Large inputs have many splits and pass unchanged; one small file would keep one core busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() * 2 <= cores else df


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
