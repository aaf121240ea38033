"""Helpers shared by the document operators."""

from __future__ import annotations

import io
import mmap
import os
import string
import sys
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.session import checkpoint_dir

#: Since Python 3.13 a mapping needs no descriptor of its own; before, each holds one, and processes have some thousand.
_FREE = sys.version_info >= (3, 13)
#: Most arrays that a worker keeps mapped; the one used longest ago goes first.
MAPPED = 8192 if _FREE else 256
_opened: OrderedDict = OrderedDict()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z and nothing else; the quick built-in serves texts without other letters."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text, with remainder 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def own_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Remove a folder that a finished step has no more use for."""
    path, context = spark._jvm.org.apache.hadoop.fs.Path(uri), spark.sparkContext
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, the shuffle files of a query go when it ends, and not only when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text (one text may be longer), to bound a task's memory."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).cumsum()
        start = 0
        while start < batch.num_rows:
            limit = (sizes[start - 1] if start else 0) + most
            end = max(start + 1, int(sizes.searchsorted(limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def local_path(uri: str) -> str | None:
    """The path of a file URI, or None for any other store."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") and "://" not in uri else None


def write_bytes(uri: str, data: bytes) -> None:
    """Write a file of a shared folder in one step: a repeated task writes the same bytes again, under a name of its own first."""
    mark = uuid.uuid4().hex
    if (path := local_path(uri)) is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(partial := f"{path}.{mark}", "wb") as out:
            out.write(data)
        os.replace(partial, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    with store.open_output_stream(partial := f"{path}.{mark}") as out:
        out.write(data)
    store.move(partial, path)


def save_array(folder: str, name: str, values: np.ndarray) -> None:
    np.save(out := io.BytesIO(), values)
    write_bytes(f"{folder}/{name}.npy", out.getvalue())


def _mapped(source) -> np.ndarray:
    """The array of an open .npy file, mapped; the file may be closed, and the mapping ends with the array."""
    major, _ = np.lib.format.read_magic(source)
    read = np.lib.format.read_array_header_1_0 if major == 1 else np.lib.format.read_array_header_2_0
    shape, fortran, kind = read(source)
    if not all(shape):
        return np.zeros(shape, kind)
    options = {"trackfd": False} if _FREE else {}
    held = mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ, **options)
    return np.ndarray(shape, kind, held, source.tell(), order="F" if fortran else "C")


def open_array(folder: str, name: str, view: Callable = lambda array: array):
    """A stored array, memory-mapped, or a view of it; one of a store without paths is first copied beside the worker."""
    uri = f"{folder}/{name}.npy"
    if uri in _opened:
        _opened.move_to_end(uri)
        return _opened[uri]
    while len(_opened) >= MAPPED:
        _opened.popitem(last=False)
    if (path := local_path(uri)) is not None:
        with open(path, "rb") as source:
            _opened[uri] = view(_mapped(source))
        return _opened[uri]
    from pyarrow import fs

    store, inside = fs.FileSystem.from_uri(uri)
    with store.open_input_stream(inside) as source, tempfile.TemporaryFile() as copy:
        while part := source.read(1 << 24):
            copy.write(part)
        copy.flush()
        copy.seek(0)
        _opened[uri] = view(_mapped(copy))  # stays readable without a name
    return _opened[uri]
