"""What a job needs of its session: the package in the executors' Python workers, a shared folder to cut lineage in."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Adds the package as a zip file to the session's application, once."""
    sc = spark.sparkContext
    if sc.applicationId not in _SENT:
        root = Path(__file__).resolve().parent
        path = Path(tempfile.mkdtemp(prefix="corvid-")) / "corvid.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(path))
        _SENT.add(sc.applicationId)
    return spark


def shared(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, spark.checkpoint.dir. A local session without it gets a temporary folder; on a cluster that is
    an error, for it would be another folder on each machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            folder = tempfile.mkdtemp(prefix="corvid-")
        if not folder:
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there: what is built on it has a short plan, and survives lost executors."""
    shared(df.sparkSession)
    return df.checkpoint()
