"""Session helpers: one place for Spark settings and the shared checkpoint folder."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str | None = None, app: str = "bundleflow",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench.

    On a cluster the session is built by the launcher; the settings here are
    the ones this library relies on (AQE, UTC, no UI) and are safe there too.
    """
    master = master or os.environ.get("BUNDLEFLOW_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("BUNDLEFLOW_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BUNDLEFLOW_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher sets it to a shared file system. Only when it is
    unset (tests, local runs) do we pick a fresh local folder of our own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a session without a local SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="bundleflow-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    return conf_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Gives the package to the Python workers, once an application: a zip in
    the shared folder, handed out by Spark. Workers need it wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(os.path.join(top, "bundleflow")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n), os.path.relpath(os.path.join(folder, n), top))
    path = scratch_path(spark, "package") + ".zip"
    write_bytes(spark, path, data.getvalue())
    spark.sparkContext.addPyFile(path)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file on whatever file system the path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


#: Bytes of an Arrow batch: those of 10,000 rows have no bound that a Python
#: worker, which holds a batch some times over, could rely on.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of about BATCH_BYTES at most (a larger row is alone), for
    the rest of the session. For what hands whole contents to Python."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/bundleflow/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written once, as Parquet below ``spark.checkpoint.dir``, and
    read again: the plan starts anew from a table whose size Spark knows, a
    lost executor costs no more than its running tasks, and every reader sees
    the same rows. One job, in which each task with side effects runs once."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    columns = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema])
    return df.sparkSession.read.schema(columns).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None when there is no such path (or a
    folder without a file yet). Any other failure to read is raised."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
