"""Helpers that the corpus operators share: the shared folder, tables that cut lineage, and document input."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a key filter for each key, and at most: 8 MB, whatever the input. A filter that would be too full to tell
#: anything is not made.
KEY_BITS, MOST_FILTER_BITS, FULL_BITS = 12, 1 << 26, 4
#: Most rows and bytes that Spark hands a Python worker at once.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """df; its session's Arrow batches are made no larger than these bounds, so that a worker's memory does not follow the
    size of texts. Every operator calls this; smaller settings stay."""
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = conf.get(key, None)
        if now is None or not now.isdecimal() or not 0 < int(now) <= most:
            conf.set(key, str(most))
    return df


def gives_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """work for mapInArrow; at the end of a task, memory that it has freed returns to the system. Python workers serve one
    task after another, and idle ones would otherwise hold as much as their largest task took."""

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim is not None:
                trim(0)

    return run


def local_table(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """A small table of the driver's rows, by way of Arrow: plain rows would start Python workers of their own to be read."""
    columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(schema.types)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=schema))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, in local mode only, a temporary one."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = os.path.join(tempfile.gettempdir(), "parcelflow-shared")
    os.makedirs(own, exist_ok=True)
    return own


_RUN = uuid.uuid4().hex


def clear_shared(spark: SparkSession) -> None:
    """Remove every table that this process has written between steps. Results not yet written read them: call it last."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/parcelflow/{_RUN}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_table(df: DataFrame, name: str, most_rows: int | None = None, rows_a_file: int = 100_000) -> DataFrame:
    """Write df to the shared folder and read it again: the lineage ends there and a lost executor loses nothing.

    With a known bound on its rows, a table gets no more files than that takes: many steps write little, and a small
    file for each shuffle partition of each would weigh on the store. Large tables keep all their partitions.
    """
    if most_rows is not None:
        df = df.coalesce(max(1, -(-most_rows // rows_a_file)))
    spark = bounded_batches(df).sparkSession
    path = f"{shared_dir(spark)}/parcelflow/{_RUN}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string, null text as empty): nothing else is read, so other columns cannot clash."""
    return bounded_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fold(id_col: str, parts: int):
    """crc32 of the id as text, modulo parts; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, with as many underscores before them as it takes to clash with none of df's."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def with_plain_names(docs: DataFrame, keep: list[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """work(docs), which returns the columns of docs, done under names that need no quotes: all columns but those of keep are
    numbered for the time being, so theirs may hold dots, blanks and quotes, or differ from others by case only."""
    held = {c.lower() for c in keep}
    plain = [c if c in keep else f"column{k}" for k, c in enumerate(docs.columns)]
    while held & {c.lower() for c in plain if c not in keep}:
        plain = [c if c in keep else "_" + c for c in plain]
    return work(docs.toDF(*plain)).toDF(*docs.columns)


def row_hash(id_col: str, text_col: str) -> Column:
    """Tells rows of one id with different texts apart; null text counts as empty."""
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))


def _filter_places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    x = keys.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return [(x + np.uint64(k) * step) & np.uint64(bits - 1) for k in range(3)]


def key_filter(keys: DataFrame, n: int | None = None):
    """A broadcast Bloom filter of the long column of keys, and its test: a function from numpy keys to booleans. None if
    there are too many keys for a filter of bounded size. n: how many keys there are at most, if that is known.

    It is true for every key of the table and for few others, so that what a join would drop anyway need not be shuffled
    first; the join still follows.
    """
    spark, col = keys.sparkSession, keys.columns[0]
    n = keys.count() if n is None else n
    if n * FULL_BITS > MOST_FILTER_BITS:
        return None
    size = min(MOST_FILTER_BITS, 1 << max(16, (n * KEY_BITS).bit_length()))

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(_filter_places(batch.column(0).to_numpy(zero_copy_only=False), size)))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["word", "bits"])

    found = keys.select(col).where(F.col(col).isNotNull()).mapInArrow(gives_back(bits), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = found.toArrow()  # at most MOST_FILTER_BITS / 64 rows
    table = np.zeros(size // 64, np.uint64)
    if found.num_rows:
        table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    shared = spark.sparkContext.broadcast(table)

    def test(keys: np.ndarray) -> np.ndarray:
        ok, table = np.ones(len(keys), bool), shared.value
        for at in _filter_places(keys, size):
            ok &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return ok

    return test


def maybe_in(df: DataFrame, col: str, keys: DataFrame, name: str = "maybe", n: int | None = None) -> DataFrame:
    """df with a boolean column: false where col is surely not in keys."""
    test = key_filter(keys, n)
    if test is None:
        return df.withColumn(name, F.lit(True))
    at, df = df.columns.index(col), bounded_batches(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = test(pc.fill_null(batch.column(at), 0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ok)], [*batch.schema.names, name])

    return df.mapInArrow(gives_back(run), T.StructType([*df.schema.fields, T.StructField(name, T.BooleanType())]))


def maybe_among(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of df whose key may be among keys (one column, distinct), and few others, in DataFrame functions alone: a bitmap
    of hashed keys is broadcast, 8 MB at most. All rows if the keys are too many for that; a join must follow."""
    n = keys.count()
    if n * FULL_BITS > MOST_FILTER_BITS:
        return df
    size = min(MOST_FILTER_BITS, 1 << max(16, (n * KEY_BITS).bit_length()))
    place, bucket, bitmap = free_names(df, "place", "bucket", "bitmap")
    at = lambda column: F.pmod(F.xxhash64(column), F.lit(size)) + 1
    bits = keys.select(at(keys.columns[0]).alias(place)).groupBy(F.bitmap_bucket_number(place).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(bitmap))
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substr(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    rows = df.withColumn(place, at(key)).withColumn(bucket, F.bitmap_bucket_number(place)).join(F.broadcast(bits), bucket)
    return rows.where(F.getbit(byte, (bit % 8).cast("int")) == 1).drop(place, bucket, bitmap)


def drop_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows of gone(doc_id, row), row being row_hash(). Only rows that the filter cannot clear are
    shuffled. docs may have columns of any name."""
    key, row, maybe, gone_id, gone_row = free_names(docs, "key", "row", "maybe", "gone_id", "gone_row")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("row").alias(gone_row)).distinct()
    keyed = docs.withColumns({key: F.col(id_col).cast("long"), row: row_hash(id_col, text_col)})
    marked = maybe_in(keyed, row, gone.select(gone_row), maybe)
    left = marked.where(F.col(maybe)).join(gone, (F.col(row) == F.col(gone_row)) & F.col(key).eqNullSafe(F.col(gone_id)), "left_anti")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~F.col(maybe)).select(*cols).union(left.select(*cols))
