"""Session defaults and the shared folder that intermediate tables live in."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets REBALANCE split a hot table partition over several writers
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    Only a ``local[...]`` session may go without that setting; it then gets a
    temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidewater-")
    return f"{root.rstrip('/')}/tidewater/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which may not have it on their path."""
    context = spark.sparkContext
    if getattr(context, "_tidewater_sent", False):
        return
    folder = Path(tempfile.mkdtemp(prefix="tidewater-"))
    archive = folder / "tidewater-package.zip"
    package = Path(__file__).resolve().parent
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._tidewater_sent = True


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty frame that the optimizer knows to be empty and folds away.

    ``createDataFrame([], schema)`` would count as a source of unknown size and
    keep the joins above it from broadcasting.
    """
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(1).where(F.lit(False)).select(nulls)
