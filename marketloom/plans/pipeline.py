"""The daily refresh: land, build the layers, check, publish."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketloom.plans.declared import DECLARED_QUERIES
from marketloom.plans.quality import evaluate
from marketloom.plans.rules import Rule, all_rules
from marketloom.plans.staging import STAGING
from marketloom.plans.warehouse import MODELS, TABLES, Warehouse, layer
from marketloom.sources.landing import PREFIX, land_raw_text
from marketloom.sources.tables import save_table


class LandingError(Exception):
    """A declared table could not be landed; the run stops before building."""


class QualityError(RuntimeError):
    """A rule of severity 'error' has failing rows; nothing was published."""


@dataclass
class Run:
    """What a refresh produced."""

    models: Warehouse
    paths: dict[str, str]
    quality: DataFrame
    landed: DataFrame | None


class _Named:
    """Models and documented columns by name."""

    def __init__(self, w: Warehouse):
        self.w = w

    def __getitem__(self, name: str) -> DataFrame:
        if name in DECLARED_QUERIES:
            return DECLARED_QUERIES[name](self.w, self.w.as_of)
        return self.w[name]


class LandedText:
    """Source tables read back from the all-text landing copies; tables that
    were not landed come from ``sources``.  Staging casts them."""

    def __init__(self, spark: SparkSession, folder: str, sources, tables: set[str]):
        self.spark, self.folder, self.sources, self.tables = spark, folder, sources, tables

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.tables:
            return self.spark.read.parquet(f"{self.folder}/{PREFIX}{name}")
        return self.sources[name]


def run_pipeline(
    spark: SparkSession,
    sources,
    out_dir: str,
    as_of=None,
    land: bool = True,
    rules: list[Rule] | None = None,
    database: str | None = None,
    threads: int = 4,
    allow_unlanded: bool = False,
) -> Run:
    """Build every model into a folder of this run and publish it.

    Publishing points names at the new folder, so readers switch at once and
    no data is copied; a failed check leaves the previous run in place.  So does
    a table that could not be landed, unless ``allow_unlanded`` lets the run
    read it from the source."""
    run_dir = f"{out_dir.rstrip('/')}/run-{uuid.uuid4().hex[:12]}"
    landed = None
    if land:
        landed = land_raw_text(spark, sources.__getitem__, f"{run_dir}/raw")
        outcome = {r["table"]: r["status"] for r in landed.collect()}
        ok = {t for t, status in outcome.items() if status == "ok"}
        if len(ok) < len(outcome) and not allow_unlanded:
            raise LandingError(f"not landed: {', '.join(sorted(outcome.keys() - ok))}")
        sources = LandedText(spark, f"{run_dir}/raw", sources, ok)

    paths: dict[str, str] = {}

    def save(df: DataFrame, name: str) -> DataFrame:
        paths[name] = f"{run_dir}/{layer(name)}/{name}"
        return save_table(df, paths[name])

    models = Warehouse(spark, sources, as_of, TABLES, save)
    models.build_all(threads)

    now = spark.range(1).select(models.as_of.cast("string")).first()[0]
    report = evaluate(
        _Named(models), all_rules() if rules is None else rules, f"timestamp_ntz'{now}'"
    )
    quality = save_table(report, f"{run_dir}/quality")
    broken = quality.filter("severity = 'error' and failing_rows > 0").collect()
    if broken:
        names = ", ".join(f"{r['model']}.{r['column']} {r['test']}" for r in broken)
        raise QualityError(f"not published: {names}")
    publish(spark, models, paths, database)
    return Run(models, paths, quality, landed)


def publish(spark: SparkSession, models: Warehouse, paths: dict[str, str], database=None) -> None:
    """Tables by name: external tables of ``database``, or temporary views.
    Staging models stay views in either case."""
    for name in STAGING:
        models[name].createOrReplaceTempView(name)
    if database is None:
        for name in set(MODELS) - set(STAGING):
            models[name].createOrReplaceTempView(name)
        return
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in paths.items():
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION '{path}'")
