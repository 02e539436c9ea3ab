"""SparkSession construction and lineage helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every slotcast job wants. Cluster deployments override the sizes.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # Tiny literal dimensions are broadcast explicitly; data-derived small sides are
    # broadcast only by AQE after it has measured them at runtime.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}
# Only used when this process starts the JVM (local runs, tests, bench).
LOCAL_CONF = {"spark.driver.memory": "8g", "spark.driver.maxResultSize": "2g"}


def get_session(master: str | None = None, app: str = "slotcast",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the slotcast defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``. Only a local master may go without: it gets a
    fresh scratch folder; on a cluster executors do not share local folders, so that is an error."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the conf is all there is
        sc = None
    current = sc.getCheckpointDir() if sc is not None and hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else "remote"
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="slotcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    if sc is not None:
        sc.setCheckpointDir(configured)
    return configured


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``slotcast`` importable in the Python workers (pandas UDFs reference its
    functions): zip the package once per application and ``addPyFile`` it, the same
    thing ``--py-files`` does on a cluster. Spark distributes the file to executors."""
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # Spark Connect
        sc, key = None, f"connect-{id(spark)}"
    if key in _SHIPPED:
        return
    import shutil
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    stage = tempfile.mkdtemp(prefix="slotcast-pyfiles-")
    archive = shutil.make_archive(os.path.join(stage, "slotcast"), "zip",
                                  root_dir=os.path.dirname(pkg_dir), base_dir=os.path.basename(pkg_dir))
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(key)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut a long lineage by writing the table as Parquet under the shared
    ``spark.checkpoint.dir`` and reading it back: one computation (an RDD checkpoint would
    compute the plan twice unless cached), compact columnar files, and the re-read gets
    column pruning, filter pushdown and real size statistics for AQE. The files live on
    the shared storage, so the result survives the loss of any executor."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/slotcast-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
