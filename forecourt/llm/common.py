"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.session import shared_dir

#: ASCII white space of the word definition ``[^\x20\x09-\x0D]+``.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; Hadoop deletes it when the driver exits."""
    path = f"{shared_dir(spark)}/llm/{tag}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(hadoop_path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing will read again."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: later steps start from files
    every executor sees, so a lost executor never repeats what came before."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column), F.lit(""))


def texts(array: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    for value in array.cast(pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()):
        yield value.as_py() or b""


def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One uint8 array with every text of a string column end to end, and the n + 1 offsets."""
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64, count=len(array) + 1 + array.offset)[array.offset:]
    data = array.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def byte_sized(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of ``column`` each (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pc.binary_length(b.column(column).cast(pa.large_string())).fill_null(0))
        group = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield b.slice(lo, hi - lo)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with rid: unique, and in the order of doc_id. Unique ids serve as they are; else the
    rows are numbered by (doc_id, with nulls last), rows with equal ids in the order they were written."""
    ids = docs.select(F.col("doc_id").cast("long").alias("d"))
    odd = ids.groupBy("d").count().where("count > 1 OR d IS NULL").limit(1).count()
    if not odd:
        return docs.withColumn("rid", F.col("doc_id").cast("long"))
    rows = materialise(docs.withColumn("row_", F.monotonically_increasing_id()), "rows")
    parts = shuffle_partitions(docs.sparkSession)
    keys = rows.select(F.col("doc_id").isNull().alias("n"), F.col("doc_id").cast("long").alias("d"), "row_")
    ranged = materialise(keys.repartitionByRange(parts, "n", "d", "row_").withColumn("p", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("p").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("p", (F.sum("size").over(Window.orderBy("p")) - F.col("size")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("p").orderBy("n", "d", "row_"))
    order = ranged.withColumn("k", rank).join(before, "p").select("row_", (F.col("before") + F.col("k")).alias("rid"))
    return rows.join(order, "row_").drop("row_")
