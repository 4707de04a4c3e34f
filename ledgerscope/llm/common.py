"""Helpers shared by the document operators: table access, folds, Arrow batches, checkpoints."""

from __future__ import annotations

import os
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerscope.session import ensure_checkpoint_dir

_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<long>": pa.list_(pa.int64()),
    "array<binary>": pa.list_(pa.binary()),
    "array<string>": pa.list_(pa.string()),
}

#: where this library lies; workers that were started elsewhere look for it here too
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: rows handed to a batch function at a time; bounds a Python worker's memory
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id falls in fold 0 (held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % F.lit(n), F.lit(0))


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary").alias("text")


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` for a function that may refer to this library."""
    packed, root = cloudpickle.dumps(function), ROOT

    def run(batches):
        import sys

        if root not in sys.path:
            sys.path.append(root)
        yield from cloudpickle.loads(packed)(batches)

    return df.mapInArrow(run, schema)


def _values(column: pa.Array) -> list:
    """The column as Python values; bytes by way of numpy, which is many times faster."""
    if pa.types.is_binary(column.type) and not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return column.to_pylist()


def map_batches(df: DataFrame, setup: Callable[[], Callable], schema: str, rows: int = SLICE) -> DataFrame:
    """``mapInArrow`` over plain Python columns.

    ``setup()`` runs once per task and returns a function from the column lists of at most
    ``rows`` rows to the output column lists, which may have another length. ``schema`` is a
    DDL string of the types above. A function ``work.finish`` yields what is left at the end.
    """
    fields = [f.strip().rsplit(" ", 1) for f in schema.split(",")]
    arrow = pa.schema([pa.field(name, _ARROW[kind]) for name, kind in fields])

    def run(batches):
        def batch_of(columns):
            arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=f.type) for v, f in zip(columns, arrow, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        work = setup()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield batch_of(work(*map(_values, batch.slice(at, rows).columns)))
        for columns in getattr(work, "finish", list)():
            yield batch_of(columns)

    return map_arrow(df, run, schema)


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def merged(df: DataFrame) -> DataFrame:
    """The side of a join that is to be shuffled and not broadcast, however small it turns out."""
    return df.hint("merge")


def keep_rows(docs: DataFrame, classes: DataFrame, digest: Column, doc_id: str = "doc_id") -> DataFrame:
    """One row of ``docs`` for each class that is kept, and none of the others.

    Rows with one id (null ids too) and one ``digest`` are a class; ``classes`` is ``doc_id, digest, kept, copies``, a
    row for each. Only the columns of ``docs`` come back, whatever their names.
    """
    odd = cut(classes.where(~F.col("kept") | (F.col("copies") > 1)).select("doc_id", "digest", "kept"))
    rows = docs.select(F.struct("*").alias("_llm_row"), F.col(doc_id).alias("_llm_id"), digest.alias("_llm_digest"))

    def same(right: DataFrame) -> Column:
        return F.col("_llm_id").eqNullSafe(right["doc_id"]) & (F.col("_llm_digest") == right["digest"])

    out = rows.join(odd, same(odd), "left_anti").select("_llm_row")
    several = odd.where("kept")
    if not several.isEmpty():
        repeated = rows.join(several, same(several), "left_semi")
        out = out.unionByName(repeated.groupBy("_llm_id", "_llm_digest").agg(F.first("_llm_row").alias("_llm_row")).select("_llm_row"))
    return out.select("_llm_row.*")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
