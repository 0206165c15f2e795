"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a batch that goes to a Python worker: with its copies on both sides it stays far below an executor's memory.
BATCH_BYTES = 4 << 20
#: Lists of the tables that written() makes; see recorded().
_recording: list[list[DataFrame]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset, a temporary one, on a local master only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is unset: a cluster needs a folder that all its machines share")
        base = f"file://{tempfile.mkdtemp(prefix='shelfwise-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; name says what is written there."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: this cuts the lineage, and a lost executor costs no recomputation."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    for tables in _recording:
        tables.append(out)
    return out


@contextmanager
def recorded() -> Iterator[list[DataFrame]]:
    """The tables that written() makes within the block, so that they can be deleted once a result that was made of them is written."""
    tables: list[DataFrame] = []
    _recording.append(tables)
    try:
        yield tables
    finally:
        _recording.pop()


def deleted(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """place (a number of its own for every row) and row (a struct of the columns of docs), as a written table.

    The number depends on how the input happens to be cut, so it is made once: all steps that join by place read this
    table, whatever executors come or go between them.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return written(docs.select(F.monotonically_increasing_id().alias("place"), row.alias("row")), name)


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches of this session's Python workers to BATCH_BYTES; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(key))) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))
