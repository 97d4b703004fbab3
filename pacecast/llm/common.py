"""Helpers shared by the training-data operators.

Scratch tables go to the folder the session names in ``spark.checkpoint.dir``
(``pacecast.session``); nothing is kept in a machine-local folder.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from ..session import remove_paths, scratch_path

#: Java pattern of the words the query contracts count (fixed value).
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scratch: list[str] = []  # tables written so far and not released


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.

    The table stays, since the result may be read at any time, until ``release``.
    """
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    _scratch.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Delete the scratch tables written so far, but for the last ``keep``.

    For callers that have stored what they need of the results.
    """
    done = _scratch[:len(_scratch) - keep]
    del _scratch[:len(done)]
    remove_paths(spark, done)


_shipped: set[str] = set()  # application ids


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context.

    Not needed where it is installed or on PYTHONPATH; else it goes with
    ``addPyFile``, which the driver serves to all executors.
    """
    sc = spark.sparkContext
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root = os.path.dirname(package)
    on_path = root in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if sc.applicationId in _shipped or on_path or os.path.basename(root) == "site-packages":
        return
    folder = tempfile.mkdtemp(prefix="pacecast-")  # served by the driver as long as it lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{os.path.basename(package)}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    out.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, work: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(work, schema)


def fold(key: Column, modulus: int) -> Column:
    """crc32 of the key as text modulo ``modulus``; -1 for a null key.

    A row without a key can't be assigned to a fold, so it is never learned
    from and counts as held out.
    """
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus, F.lit(-1))


def sampled_texts(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_label, _text) of the chosen ids (_id, _label), which are broadcast: one text an id.

    Of a repeated id's texts it is the smallest, found in each task first.
    """
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
            .select("_label", "_text"))


def others(df: DataFrame, *new: str) -> list[str]:
    """The columns of ``df`` that stay beside the new ones: an old column gives way to a new one's name."""
    taken = {n.lower() for n in new}
    return [c for c in df.columns if c.lower() not in taken]


def columns(df: DataFrame, names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def beside(df: DataFrame, kept: list[str], value: str) -> tuple[DataFrame, list[StructField]]:
    """The ``kept`` columns under numbers and ``value`` as the last one, and the kept fields by name."""
    numbered = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(kept)]
    source = df.select(*numbered, F.col(f"`{value}`").alias("_value"))
    return source, [StructField(c, f.dataType) for c, f in zip(kept, source.schema.fields, strict=False)]


def slices(batches: Iterator[pa.RecordBatch], text: int, max_chars: int = 4_000_000,
           max_rows: int = 2_000) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Batches cut so that one slice holds ``max_rows`` rows and about ``max_chars`` of text.

    ``text`` is the text column's place. A single longer text makes a slice of
    its own; texts are never cut.
    """
    for batch in batches:
        values = batch.column(text).to_pylist()
        start = chars = 0
        for i, value in enumerate(values):
            size = len(value or "")
            if i > start and (chars + size > max_chars or i - start >= max_rows):
                yield batch.slice(start, i - start), values[start:i]
                start, chars = i, 0
            chars += size
        if start < len(values):
            yield batch.slice(start), values[start:]
