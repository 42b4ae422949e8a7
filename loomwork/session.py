"""Makes the package importable on the workers of any cluster."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[tuple[str, str]] = set()

#: Batches to Python hold so much at most (unless the session asks for less), so that long texts don't fill a worker.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Gives Spark a zip of this package for its workers, once per application; cheap to call again."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) > BATCH_BYTES:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(p.relative_to(root.parent))), p.read_bytes())
    mark = hashlib.sha256(data.getvalue()).hexdigest()[:16]
    if (context.applicationId, mark) in _shipped:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="loomwork-"), f"loomwork-{mark}.zip")
    Path(path).write_bytes(data.getvalue())
    context.addPyFile(path)
    _shipped.add((context.applicationId, mark))


def shared_folder(spark: SparkSession) -> str:
    """Where all executors can read and write: ``spark.checkpoint.dir``. Only on one machine may that be unset; a temporary folder
    serves then."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset: a cluster needs a shared folder")
    return base or tempfile.mkdtemp(prefix="loomwork-")


def scratch(spark: SparkSession) -> str:
    """A new folder's path in the shared folder."""
    return f"{shared_folder(spark)}/loomwork-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there, so that what uses it twice doesn't make it twice."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
