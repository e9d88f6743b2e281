"""A session with the settings the operators are tuned for."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the JVM leaves methods above 8000 bytes uncompiled; wide projections do better split up
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a workbook is one record: keep the batches sent to the decoder small
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # rows reach a state or staging table once per batch, by partition
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def builder(app: str = "storelens", **settings: str) -> SparkSession.Builder:
    out = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        out = out.config(key, value)
    return out


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, where it is not installed on the executors."""
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    with tempfile.TemporaryDirectory() as folder:  # on the driver; Spark copies it to its file server
        path = os.path.join(folder, "storelens.zip")
        with open(path, "wb") as out:
            out.write(packed.getvalue())
        spark.sparkContext.addPyFile(path)


def session(app: str = "storelens", **settings: str) -> SparkSession:
    """A session whose workers can import this package."""
    spark = builder(app, **settings).getOrCreate()
    ship(spark)
    return spark


def local_session(app: str = "storelens", cpus: int = 8, memory: str = "8g", **settings: str) -> SparkSession:
    """A session in this process, for tests and measurements."""
    spark = builder(app, **{
        "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": memory, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", **settings}).master(f"local[{cpus}]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
