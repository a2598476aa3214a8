"""Helpers shared by the training-data operators: shared storage, row structs through Arrow, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: A-Z to a-z, other bytes unchanged; in UTF-8 this lower-cases exactly the ASCII letters.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: The same, and bytes that are no part of a word (neither digit, letter nor non-ASCII) to space.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))
#: Bytes of text handled at once inside a task; a longer single text is handled alone.
CHUNK_BYTES = 2 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir. Unset, a local session gets a folder of its own; a
    cluster must set it, since its executors share no local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to shared storage and read back: lineage ends here and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[[Iterator[pa.StructArray]], Iterator[list[pa.Array]]],
             columns: StructType) -> DataFrame:
    """Columns ``row`` (all columns of ``df`` as one struct, so names cannot clash) and ``columns``.

    ``fn`` gets the row structs batch by batch and yields one list of arrays per batch."""
    packed = df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))
    schema = StructType([packed.schema["row"], *[StructField(c.name, c.dataType) for c in columns]])
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.StructArray] = []

        def rows():
            for b in batches:
                kept.append(b.column(0))
                yield b.column(0)

        for arrays in fn(rows()):
            yield pa.RecordBatch.from_arrays([kept.pop(), *arrays], names=names)

    return packed.mapInArrow(run, schema)


def texts_of(rows: pa.StructArray, name: str) -> pa.StringArray:
    return pc.struct_field(rows, name).cast(pa.string())


def raw_texts(texts: pa.StringArray) -> Iterator[bytes]:
    """UTF-8 bytes of each text, null as empty, without making Python strings."""
    n = len(texts)
    if not n:
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32, n + 1, texts.offset * 4).tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    valid = texts.is_valid().to_pylist() if texts.null_count else None
    for i in range(n):
        yield bytes(view[at[i]:at[i + 1]]) if valid is None or valid[i] else b""


def chunks(texts: pa.StringArray, limit: int = CHUNK_BYTES) -> Iterator[list[bytes]]:
    """Consecutive texts in lists of about ``limit`` bytes; each text stays whole."""
    out: list[bytes] = []
    size = 0
    for t in raw_texts(texts):
        out.append(t)
        size += len(t) + 64
        if size >= limit:
            yield out
            out, size = [], 0
    if out:
        yield out


def crc_mod(column: str, n: int):
    """crc32 of the id as text modulo n; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("null")).cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable, limit: int,
                    id_col: str, text_col: str) -> DataFrame:
    """At most ``limit`` labelled documents (``y``, ``text``), chosen by a hash of the id.

    ``usable``: condition on the id column. Ids with contradicting labels get the larger label;
    repeated document rows count once per row. The id list is bounded by ``limit``, so its
    broadcast is too."""
    picked = (labels.select(F.col(id_col).alias("k"), F.col(label).cast("int").alias("y"))
              .where(F.col("k").isNotNull() & F.col("y").isin(0, 1))
              .withColumnRenamed("k", id_col).where(usable)
              .groupBy(id_col).agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64(id_col), id_col).limit(limit))
    return (docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(picked), id_col).select("y", "text"))
