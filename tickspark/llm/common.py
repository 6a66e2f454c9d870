"""Helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tickspark.session import work_dir

#: Words as the contracts of these operators cut them: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: ASCII white space, for ``str.split`` on it alone (``str.split()`` also cuts at Unicode spaces).
BLANKS = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def words(text: str | None) -> list[str]:
    """The words of a text. Null has none."""
    return [w for w in text.translate(BLANKS).split(" ") if w] if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    It cuts lineage: what was written survives the loss of executors, is never computed twice, and its
    arbitrary choices (among ties, say) are the same for every later reader.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fitting_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores, such that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tickspark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="tickspark-code-"), "tickspark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "tickspark")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    context.addPyFile(path)
    context._tickspark_shipped = True


def give_back() -> None:
    """Hand memory that a task no longer needs to the system; Python workers live on after it, for hours."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors. What a task held is given back at its end."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return df.mapInArrow(run, schema)


def batches_by_key(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups out of batches that are sorted by ``keys``."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False)) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new), batch.num_rows]
        rows = pa.Table.from_batches([batch])
        for a, b in zip(cuts, cuts[1:]):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(rows.slice(a, b - a))
            last = key
    if held:
        yield pa.concat_tables(held)


def map_groups(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], dict[str, list] | None], schema: str) -> DataFrame:
    """``fn`` applied to each group of ``keys`` (not null), which must fit into a task's memory.

    Unlike ``applyInArrow`` it passes many small groups in one batch between the JVM and Python.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in batches_by_key(batches, keys):
            made = fn(group)
            if made is not None:
                yield pa.RecordBatch.from_pydict({f.name: pa.array(made[f.name], f.type) for f in out}, out)

    return map_batches(df.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def list_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists of numbers as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(n, -1) if n else values.reshape(0, 0)
