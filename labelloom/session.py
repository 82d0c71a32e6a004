"""Session settings and the shared folder for materialised stages."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the library is tuned for. Joins carry no broadcast hints: the optimizer compares real sizes with the
# thresholds below and shuffles (with skew splitting) whatever is larger.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "labelloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="labelloom-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


@cache
def _ship_to(application: str) -> str:
    """Zip of the package for one application; Spark serves the driver's copy to the executors."""
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="labelloom-ship-")) / "labelloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    return str(archive)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once per application; call it before a job whose functions import it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_ship_to(context.applicationId))
        _shipped.add(context.applicationId)


_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    _made.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def delete_stages(spark: SparkSession) -> int:
    """Delete every intermediate table of this process; call it once all results that read them are written."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    count = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        count += bool(path.getFileSystem(conf).delete(path, True))
    return count


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Lineage ends at files that outlive any executor, and the files carry sizes, so later joins are planned on facts.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
