"""Session builder and the few settings that the engine needs."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def build(cores: int | str = 8, memory: str = "8g", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitter's settings hold instead."""
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([ROOT, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]))
    base = {
        "spark.master": f"local[{cores}]",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
    }
    return SparkSession.builder.config(map=base | conf).getOrCreate()


#: Rows of an Arrow batch. They can be whole texts or images, so batches are far smaller than Spark's default of 10,000.
BATCH = "500"


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package, and hand them small batches unless the session says otherwise.

    Workers take PYTHONPATH from the context's environment. On a cluster the package comes with
    ``--py-files``; the extra entry then names a folder that isn't there, which does no harm.
    """
    env = spark.sparkContext.environment
    env["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([ROOT, *filter(None, env.get("PYTHONPATH", "").split(os.pathsep))]))
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a session in one process may do without and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return folder or tempfile.mkdtemp(prefix="checkpoints-")


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, for tables that a plan reads several times; it survives lost executors."""
    spark = df.sparkSession
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
