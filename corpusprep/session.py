"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "corpusprep", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ship(builder.getOrCreate())


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable by the Python workers of a session."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="corpusprep-zip-")) / "corpusprep.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(app)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="corpusprep-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result that several branches read, and continue from the written table.

    The table survives the loss of executors, and every branch sees the same rows.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SETTLE_LEAVES = 12


def settled(df: DataFrame, name: str = "settled", leaves: int = SETTLE_LEAVES) -> DataFrame:
    """Write the result so far once its plan reads more than ``leaves`` inputs.

    Operators that fold summaries back into their rows use their input twice, so
    a chain of them would double its plan at every step. Cutting the chain keeps
    the work linear; short chains stay lazy.
    """
    if df.isStreaming or df._jdf.queryExecution().analyzed().collectLeaves().size() <= leaves:
        return df
    return materialise(df, name)
