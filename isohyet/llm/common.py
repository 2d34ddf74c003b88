"""Shared plumbing: the documents table, durable intermediates and files in the folder all executors share."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the documents table, in order.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def fresh(columns: Iterable[str], name: str) -> str:
    """The name, with as many underscores after it as it takes to be none of the given columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where unset, a new local one is set (tests, single machine).

    On a cluster the setting is required: a local folder of one machine is none that the others see.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not held.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = held.get() if held.isDefined() else f"file://{tempfile.mkdtemp(prefix='isohyet-')}"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def durable(df: DataFrame) -> DataFrame:
    """Materialise in the shared folder: computed once, and safe when executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Folders that this process made and has not dropped yet, in order.
_MADE: list[str] = []


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh folder URI under the shared folder."""
    path = f"{shared_dir(spark)}/isohyet/{kind}-{uuid.uuid4().hex}"
    fs, inner = open_fs(path)
    fs.create_dir(inner, recursive=True)
    _MADE.append(path)
    return path


def made_folders() -> list[str]:
    return list(_MADE)


def drop_folders(uris: Iterable[str]) -> None:
    """Remove folders of intermediates; only once what reads them has been written elsewhere."""
    for uri in uris:
        fs, inner = open_fs(uri)
        fs.delete_dir(inner)
        _MADE.remove(uri)


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Written to the shared folder as Parquet and read again: compressed, and safe when executors are lost."""
    folder = new_folder(df.sparkSession, kind)
    df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI (file, hdfs, s3, gs, ...) and the path inside it."""
    return pafs.FileSystem.from_uri(uri)


def spread(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Deal rows by key over n tasks, for work whose size is not the size of its rows."""
    return df.repartition(max(1, n), *keys)


def utf8(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A string column without nulls (null: empty), with 64-bit offsets so that any batch fits."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def give_back() -> None:
    """Return freed memory to the system: Python workers stay for later stages, and should not keep what this one needed."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)
