"""Shared pieces of the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Broadcast at most this many rows of keys; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
#: Bytes of rows handed to a Python worker at a time; several copies of them are
#: in memory at once there.
ARROW_BYTES = "8m"


def text_bytes(column: str | Column) -> Column:
    """The UTF-8 bytes of a text column (null stays null)."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


def row_name(*columns: Column) -> Column:
    """A 128-bit name of a row by some of its columns; null is a value like others."""
    told = [x for c in columns for x in (c.isNull(), c)]
    return F.struct(*[F.xxhash64(F.lit(i), *told).alias(f"r{i}") for i in (1, 2)])


def map_texts(
    df: DataFrame,
    carry: list[str] | list[Column],
    text: Column,
    result: T.StructType,
    compute: Callable[[list], list[tuple]],
) -> DataFrame:
    """One result per row of ``df``, computed from the bytes of ``text``.

    ``compute`` takes a list of bytes (or None) and returns one tuple per entry.
    The output has two struct columns: ``row`` with the carried columns and
    ``out`` with ``result``, so no name of the input can clash with a result.
    Rows are streamed in Arrow batches; nothing is gathered."""
    out_type = to_arrow_type(result)
    names = result.fieldNames()
    source = df.select(F.struct(*carry).alias("row"), text.alias("text"))
    schema = T.StructType(
        [source.schema["row"], T.StructField("out", result, False)]
    )

    def run(batches):
        for batch in batches:
            rows = compute(batch.column("text").to_pylist())
            columns = list(zip(*rows)) or [()] * len(names)
            arrays = [
                pa.array(c, type=out_type.field(i).type) for i, c in enumerate(columns)
            ]
            out = pa.StructArray.from_arrays(arrays, fields=list(out_type))
            yield pa.RecordBatch.from_arrays([batch.column("row"), out], ["row", "out"])

    return source.mapInArrow(run, schema)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when a written ``df`` is counted to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def reach_workers(spark) -> None:
    """Let Python workers import this package from where the driver has it (a
    cluster without that folder gets it as a file of ``--py-files``), and hand
    texts to them in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
