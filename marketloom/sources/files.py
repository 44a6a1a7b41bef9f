"""CSV loader: one header file (or folder of files) per source table."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.functions import pad_zip
from marketloom.sources.records import quoted_records
from marketloom.sources.schemas import SOURCES, SourceTable
from marketloom.sources.tables import save_table

log = logging.getLogger(__name__)


def clean_name(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def conform(df: DataFrame, source: SourceTable) -> DataFrame:
    """Give a frame of any column order and of text columns the declared types."""
    cols = []
    for f in source.schema.fields:
        c = F.col(f.name)
        if f.name == source.zip_column:
            c = pad_zip(c)
        elif isinstance(f.dataType, T.IntegerType):
            # counts that passed through a float column read "3.0"
            c = c.cast("double").cast("int")
        else:
            c = c.cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def read_csv(spark: SparkSession, path: str, source: SourceTable) -> DataFrame:
    """Read with cleaned header names, then cast by name; no type inference,
    so zip prefixes keep their leading zeros.  Files with line breaks inside of
    fields are split between tasks like others, by ``quoted_records``."""
    options = {"quote": '"', "escape": '"', "multiLine": str(source.free_text).lower()}
    raw = spark.read.options(header=True, **options).csv(path)
    names = [clean_name(c) for c in raw.columns]
    if not source.free_text:
        return conform(raw.toDF(*names), source)
    fields = ", ".join(f"`{n}` string" for n in names)
    records = quoted_records(spark, path).filter("not first")
    return conform(records.select(F.from_csv("record", fields, options).alias("r")).select("r.*"), source)


def load_csv_to_table(
    spark: SparkSession, path: str, table: str, out_dir: str, if_exists: str = "replace"
) -> DataFrame:
    """Load one CSV into ``out_dir/table``; ``if_exists`` is replace or append."""
    if if_exists not in ("replace", "append"):
        raise ValueError(f"if_exists must be 'replace' or 'append', not {if_exists!r}")
    mode = "overwrite" if if_exists == "replace" else "append"
    return save_table(read_csv(spark, path, SOURCES[table]), f"{out_dir}/{table}", mode)


def load_all(spark: SparkSession, csv_dir: str, out_dir: str) -> dict[str, str]:
    """Load every declared source.  A missing file is logged and skipped; any
    other failure stops the run.  Returns table -> 'loaded' | 'skipped'."""
    outcome = {}
    for name, source in SOURCES.items():
        path = f"{csv_dir}/{source.file}"
        try:
            df = read_csv(spark, path, source)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            log.warning("file %s not found, table %s skipped", path, name)
            outcome[name] = "skipped"
            continue
        save_table(df, f"{out_dir}/{name}")
        outcome[name] = "loaded"
    return outcome
