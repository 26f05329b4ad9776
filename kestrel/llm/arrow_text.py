"""Text columns of Arrow batches as flat byte arrays, in pieces of bounded size.

Python stages get Arrow batches from ``mapInArrow``. They work on whole texts, but on a bounded
number of bytes at a time, so a worker's memory follows ``PIECE_BYTES`` (or the longest single
text, if that is longer), never the partition.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PIECE_BYTES = 1 << 20


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as large_string without nulls (a null text counts as empty)."""
    column = batch.column(name)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of length n + 1); offsets start at 0."""
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    return flat, off - off[0]


def pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [start, stop) of about ``piece_bytes`` each; a longer text is a range of its own."""
    _, off = byte_view(texts)
    start = 0
    while start < len(texts):
        stop = int(np.searchsorted(off, off[start] + piece_bytes, side="right")) - 1
        stop = max(stop, start + 1)
        yield start, stop
        start = stop


def named(column: str) -> Column:
    """The top-level column of exactly this name, whatever characters it holds."""
    return F.col("`" + column.replace("`", "``") + "`")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors through Spark, once per application, so that Python
    workers can import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="kestrel-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def map_texts(docs: DataFrame, text_col: str, keep: Sequence[str],
              make: Callable[[pa.Array], Sequence[Any]], result: str) -> DataFrame:
    """``keep`` columns unchanged, then the columns of ``result`` (a DDL string) that ``make``
    returns for the texts of each piece. No other column of ``docs`` is read."""
    ship_package(docs.sparkSession)
    chosen = docs.select(*[named(c) for c in keep], named(text_col).cast("string").alias("__text"))
    made = T.StructType.fromDDL(result)
    schema = T.StructType([chosen.schema[i] for i in range(len(keep))] + made.fields)
    width, kinds = len(keep), [T.StructType([f]) for f in made.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = [to_arrow_schema(k).field(0).type for k in kinds]
        for batch in batches:
            texts = text_column(batch, "__text")
            for start, stop in pieces(texts):
                found = make(texts.slice(start, stop - start))
                columns = [c.slice(start, stop - start) for c in batch.columns[:width]]
                columns += [x if isinstance(x, pa.Array) else pa.array(x, type=k) for x, k in zip(found, arrow)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return chosen.mapInArrow(run, schema)


_MADE: dict[str, Any] = {}


def worker_memo(key: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker builds once and keeps for its next tasks. ``key`` names the
    object (one per call on the driver); the last few are kept."""
    if key not in _MADE:
        while len(_MADE) >= 4:
            _MADE.pop(next(iter(_MADE)))
        _MADE[key] = make()
    return _MADE[key]
