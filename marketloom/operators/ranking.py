"""Global ranks without a single-partition window.

``percent_rank() over (order by x)`` has no partition key, so Spark's own
window moves every row to one task.  Here the rows are range-partitioned, each
partition is numbered on its own, and the partition totals (one row per
partition) are turned into offsets.

Ties and hot values cost nothing: ranks are computed over *distinct values with
counts*, so a value held by a third of all rows is one row of the frequency
table after map-side aggregation.  NULLs never enter the shuffle at all; their
rank follows from the counts.

The range-partitioned frame is written to a scratch table before it is used
twice: range bounds are sampled, and a recomputed stage could draw other ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from marketloom.sources.tables import write_scratch

#: Rows of a key beyond which they are numbered by several tasks.
HEAVY = 100_000


def positions(
    df: DataFrame, order: list[str], weight: str | None = None, label: str = "ranked"
) -> DataFrame:
    """Add ``before``: the total weight (rows, by default) sorted ahead of each
    row under ascending ``order``.  ``order`` should identify rows uniquely."""
    w = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    ranged = write_scratch(
        df.repartitionByRange(*order).withColumn("_pid", F.spark_partition_id()), label
    )
    prior = (W.unboundedPreceding, -1)
    # one row per range partition: at most spark.sql.shuffle.partitions rows
    offsets = (
        ranged.groupBy("_pid")
        .agg(F.sum(w).alias("_s"))
        .select(
            "_pid",
            F.coalesce(F.sum("_s").over(W.orderBy("_pid").rowsBetween(*prior)), F.lit(0))
            .alias("_offset"),
        )
    )
    local = F.sum(w).over(W.partitionBy("_pid").orderBy(*order).rowsBetween(*prior))
    return (
        ranged.withColumn("_local", F.coalesce(local, F.lit(0)))
        .join(F.broadcast(offsets), "_pid")
        .withColumn("before", F.col("_offset") + F.col("_local"))
        .drop("_pid", "_local", "_offset")
    )


def _rank_type(df: DataFrame, cols: list[str]) -> str:
    exact = (T.IntegralType, T.DecimalType)
    return (
        "decimal(38,6)"
        if all(isinstance(df.schema[c].dataType, exact) for c in cols)
        else "double"
    )


def percent_ranks(
    df: DataFrame, key: str, specs: dict[str, tuple[str, str]]
) -> DataFrame:
    """Add several whole-table ``percent_rank`` columns in one pass.

    ``specs`` maps output name -> (column, flavour):

    * ``asc``        ascending, NULLs last
    * ``desc``       descending, NULLs first
    * ``asc_known``  ascending among non-NULL values; NULL stays NULL

    ``key`` must be unique.  All columns share one frequency table, one range
    shuffle and one join back, whatever their number."""
    cols = sorted({c for c, _ in specs.values()})
    kind = _rank_type(df, cols)
    long = (
        df.select(
            key,
            F.explode(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("_i"), F.col(c).cast(kind).alias("_v"))
                        for i, c in enumerate(cols)
                    ]
                )
            ).alias("_e"),
        )
        .select(key, "_e._i", "_e._v")
        .filter("_v is not null")
    )
    freq = long.groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = positions(freq, ["_i", "_v"], "_n", "percent-rank")
    # a single row of counts, one per ranked column
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(c).alias(c) for c in cols]
    ).first()
    n, known = counts["n"], [counts[c] for c in cols]

    per_key = (
        long.join(placed, ["_i", "_v"])
        .groupBy(key)
        .agg(
            *[F.max(F.when(F.col("_i") == i, F.col("before"))).alias(f"_b{i}")
              for i in range(len(cols))],
            *[F.max(F.when(F.col("_i") == i, F.col("_n"))).alias(f"_m{i}")
              for i in range(len(cols))],
        )
    )

    def rank(column: str, flavour: str) -> Column:
        i = cols.index(column)
        # values of earlier columns precede in the shared table
        before = F.col(f"_b{i}") - F.lit(sum(known[:i]))
        missing = F.col(f"_b{i}").isNull()
        if flavour == "asc_known":
            return F.when(~missing, _share(before, known[i]))
        if flavour == "asc":
            return _share(F.when(missing, F.lit(known[i])).otherwise(before), n)
        if flavour == "desc":
            after = F.lit(n) - before - F.col(f"_m{i}")
            return _share(F.when(missing, F.lit(0)).otherwise(after), n)
        raise ValueError(f"unknown rank flavour {flavour!r}")

    return df.join(per_key, key, "left").select(
        *[F.col(c) for c in df.columns],
        *[rank(c, flavour).alias(out) for out, (c, flavour) in specs.items()],
    )


def _share(ahead: Column, rows: int) -> Column:
    if rows < 2:
        return F.lit(0.0)
    return ahead.cast("double") / F.lit(float(rows - 1))


def ntile(df: DataFrame, key: str, column: str, buckets: int, out: str) -> DataFrame:
    """``ntile(buckets) over (order by column nulls last, key)``.

    Returns ``key``, ``column`` and ``out`` only, so wide rows are not moved."""
    narrow = df.select(key, column, F.col(column).isNull().alias("_null"))
    placed = positions(narrow, ["_null", column, key], label="ntile")
    rows = df.count()
    size, big = divmod(rows, buckets)
    cut = big * (size + 1)
    p = F.col("before")
    tile = F.when(
        p < cut, F.floor(p / F.lit(size + 1)) + 1
    ).otherwise(F.lit(big) + F.floor((p - cut) / F.lit(max(size, 1))) + 1)
    return placed.select(key, column, tile.cast("bigint").alias(out))


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys of more than ``HEAVY`` rows, written, as ``_key``: at most one for every
    ``HEAVY`` rows."""
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return write_scratch(sizes.filter(F.col("_rows") > HEAVY).select("_key"), "heavy")


def number_within(
    df: DataFrame, key: str, order: list[str], out: str, heavy: DataFrame | None = None
) -> DataFrame:
    """``row_number() over (partition by key order by order)`` as ``out``.

    Rows are dealt by key, once.  Keys of more than ``HEAVY`` rows (NULL is a key like
    the others) are left out of that: their rows are numbered across range partitions
    and shifted by the first position of their key, so a key of any size is spread
    over as many tasks as its rows need.  ``heavy`` are the ``heavy_keys``, if they are known."""
    number = F.row_number().over(W.partitionBy(key).orderBy(*order)).alias(out)
    heavy = heavy_keys(df, key) if heavy is None else heavy
    if heavy.isEmpty():
        return df.select(*df.columns, number)
    # at most one key for every HEAVY rows
    own, few = F.col(key).eqNullSafe(F.col("_key")), F.broadcast(heavy)
    light = df.join(few, own, "left_anti").select(*df.columns, number)
    return light.union(_number_across(df.join(few, own, "left_semi"), key, order, out))


def _number_across(df: DataFrame, key: str, order: list[str], out: str) -> DataFrame:
    placed = positions(df, [key, *order], label="numbering")
    first = placed.groupBy(F.col(key).alias("_key")).agg(F.min("before").alias("_first"))
    return (
        placed.join(first, F.col(key).eqNullSafe(F.col("_key")))
        .withColumn(out, (F.col("before") - F.col("_first") + 1).cast("int"))
        .select(*df.columns, out)
    )
