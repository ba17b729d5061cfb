"""Sessions, and getting this package to the executors."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> SparkSession:
    """Makes this package importable in the executors' Python workers, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_rasterweave_shipped", None) is None:
        at = Path(tempfile.mkdtemp(prefix="spark-code-")) / f"{ROOT.name}.zip"
        with zipfile.ZipFile(at, "w") as out:
            for path in sorted(ROOT.rglob("*.py")):
                out.write(path, path.relative_to(ROOT.parent))
        context.addPyFile(str(at))
        context._rasterweave_shipped = str(at)
    return spark


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.sql.shuffle.partitions": str(cpus), "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.sql.adaptive.enabled": "true", "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ship(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share: spark.checkpoint.dir. Where that is unset, one of our own on a single machine (tests), an error on a cluster."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\[]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """df as a written table in the shared folder: cuts lineage, and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
