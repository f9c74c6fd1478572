"""Shared working tables: written once, read many times, seen by the driver and by every executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Where none is set, a local session (tests) gets one; a cluster must name its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="work-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage, and later readers do not compute it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Remove the table that ``keep`` wrote; call it only when nothing will read ``df`` again."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """``df``, with Arrow batches of at most ``rows`` rows in its session: whole texts are wide, and a batch is held several times."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(setting)) <= rows:
        df.sparkSession.conf.set(setting, str(rows))
    return df


def whole_text(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` already has such a column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def map_texts(docs: DataFrame, doc_id: str, text: str, fields: str, make: Callable[[], Callable[[list[str]], list[list]]],
              block_bytes: int = 1 << 20) -> DataFrame:
    """One row per row of ``docs``: its id (any type, nulls kept) and ``fields``, a DDL string, made from whole texts (null: empty).

    ``make`` runs once in a task and gives the function that turns the texts of a block into columns. Blocks hold at least one
    text and about ``block_bytes`` bytes, so memory does not follow the size of a partition.
    """
    chosen = small_batches(docs).select(F.col(doc_id).alias("id"), whole_text(text).alias("text"))
    schema = T.StructType([chosen.schema["id"], *T.StructType.fromDDL(fields)])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:  # only a block's texts are Python objects at a time
                end = min(batch.num_rows, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + block_bytes)) + 1)
                part = batch.slice(start, end - start)
                arrays = [pa.array(c, k) for c, k in zip(work(part.column(1).to_pylist()), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=schema.names)
                start = end

    return chosen.mapInArrow(run, schema).withColumnRenamed("id", doc_id)
