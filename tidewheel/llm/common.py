"""What the operators of this folder share: staged tables, hold-out marks, bounded text blocks."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewheel.session import shared_dir, ship

FOLDS = 5
TEXT_BLOCK = 4 << 20
"""Characters of text that a Python task works on at a time."""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_OPEN: list[list[DataFrame]] = []
"""Staged tables of the open workspaces, innermost last."""


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read back: a cut in the lineage
    that outlives lost executors, and a place where generated row ids are fixed.

    The table stays until it is released, or until the workspace that it was made in ends.
    """
    spark = df.sparkSession
    ship(spark)
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    if _OPEN:
        _OPEN[-1].append(out)
    return out


def release(*tables: DataFrame) -> None:
    """Removes staged tables, whose rows are no longer asked for: what was derived from
    them has itself been written, so a lost executor does not ask for them again."""
    for table in tables:
        for held in _OPEN:
            held[:] = [one for one in held if one is not table]
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs. Otherwise they stay until the driver's
    JVM happens to collect its garbage, which may be after the last job, however large they are.
    Spark's threads hold on to the last job that they have seen, so a small one comes first."""
    spark.range(1).count()
    time.sleep(0.3)
    gc.collect()
    for _ in range(2):
        spark.sparkContext._jvm.System.gc()


@contextmanager
def workspace() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Removes at its end what operators have staged inside, but for tables passed to the
    function it gives: ``with workspace() as keep: docs = keep(staged(...))``."""
    held: list[DataFrame] = []
    _OPEN.append(held)

    def keep(table: DataFrame) -> DataFrame:
        held[:] = [one for one in held if one is not table]
        if len(_OPEN) > 1:
            _OPEN[-2].append(table)
        return table

    try:
        yield keep
    finally:
        _OPEN.remove(held)
        release(*held)


def held_out(doc_id: Column) -> Column:
    """The fifth of the documents that no model of this folder learns from."""
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


def sample_rows(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key``: the same ones in every run.

    All rows if there are no more than ``rows``.
    """
    total = df.count()
    if total <= rows:
        return df
    top = 1 << 30
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(top)) < int(top * rows / total))


def text_blocks(batch: pa.RecordBatch, column: str = "text", size: int = TEXT_BLOCK) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, one row at least."""
    start, held = 0, 0
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    for row, more in enumerate(sizes):
        if held and held + more > size:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += more
    if start < batch.num_rows:
        yield batch.slice(start)


def put(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with ``columns`` set as ``DataFrame.withColumns`` sets them: an input
    column of the same name, in either case, is replaced; others are appended."""
    names, arrays = batch.schema.names, list(batch.columns)
    for name, array in columns.items():
        found = [i for i, old in enumerate(names) if old.lower() == name.lower()]
        for i in found:
            names[i], arrays[i] = name, array
        if not found:
            names.append(name)
            arrays.append(array)
    return pa.RecordBatch.from_arrays(arrays, names)


def schema_with(df: DataFrame, **kinds: str) -> T.StructType:
    """The schema of ``df`` after ``put`` of columns of these kinds."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items()}).schema


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def schema_of(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields])


def send_file(spark: SparkSession, content: bytes, suffix: str) -> str:
    """Makes ``content`` a file of the application, which Spark fetches to any
    executor that runs a task, also to one that joins later; returns its name."""
    name = f"{uuid.uuid4().hex}{suffix}"
    path = os.path.join(tempfile.mkdtemp(prefix="tidewheel-"), name)
    with open(path, "wb") as file:
        file.write(content)
    spark.sparkContext.addFile(path)
    return name


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: the group of each member, and its place in the group."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)


_CODEC = pa.Codec("zstd", compression_level=3)


def _pack(text: str | None) -> tuple[int, bytes]:
    raw = (text or "").encode("utf-8", "replace")
    return len(raw), _CODEC.compress(raw, asbytes=True)


def packed_texts(texts: DataFrame, *id_cols: str) -> DataFrame:
    """(ids, size, packed) of (ids, text): UTF-8 bytes, compressed for a shuffle. Ids are longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch):
                packs = [_pack(text) for text in block.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        **{name: block.column(name) for name in id_cols},
                        "size": pa.array([size for size, _ in packs], pa.int64()),
                        "packed": pa.array([packed for _, packed in packs], pa.binary()),
                    }
                )

    ids = "".join(f"{name} long, " for name in id_cols)
    return texts.select(*id_cols, "text").mapInArrow(run, f"{ids}size long, packed binary")


def packed_numbers(values: np.ndarray) -> bytes:
    """Numbers from 0 to 2^32 - 1, compressed."""
    raw = np.ascontiguousarray(values, "<u4").tobytes()
    return len(values).to_bytes(4, "little") + _CODEC.compress(raw, asbytes=True)


def unpacked_numbers(packed: bytes) -> np.ndarray:
    size = int.from_bytes(packed[:4], "little")
    return np.frombuffer(_CODEC.decompress(packed[4:], 4 * size, asbytes=True) if size else b"", "<u4").astype(np.int64)


def unpack(packed: bytes, size: int) -> bytes:
    return _CODEC.decompress(packed, size, asbytes=True) if size else b""
