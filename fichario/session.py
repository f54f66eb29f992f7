"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "fichario", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on. Cluster sizes come from spark-submit, not from here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Split hot join keys even where the split costs one more shuffle downstream.
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: spark.checkpoint.dir of the session.

    Only where the session names none (local tests) a folder of this machine is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="fichario-")
        configured = _LOCAL_FOLDERS[app]
    # Qualified, so that a path without a scheme means the cluster's file system everywhere.
    files, path = _files(spark, configured.rstrip("/"))
    return files.makeQualified(path).toString()


def _files(spark: SparkSession, path: str):
    """File system of a path, and the path in its terms."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path."""
    files, path = _files(spark, path)
    return files.getContentSummary(path).getLength()


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark)}/fichario/{label}-{uuid.uuid4().hex}"


def settled(rows: DataFrame) -> DataFrame:
    """The same rows, with what stands below made once and where it stands. Spark moves the conditions of later
    filters neither below a condition that is not deterministic for it nor, with them, copies of all the
    expressions they name; columns that nobody asks for still leave."""
    return rows.filter(F.spark_partition_id() >= 0)


def made_first(rows: DataFrame) -> DataFrame:
    """The same rows, whose columns are made before any later filter or rule that names them: a projection with
    a value that is not deterministic holds both back, so none takes a copy of the expressions it names."""
    return rows.withColumn("_made_at", F.spark_partition_id()).filter("_made_at >= 0").drop("_made_at")
