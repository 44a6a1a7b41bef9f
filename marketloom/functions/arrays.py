"""Array helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest_zip(df: DataFrame, keep: list[str], arrays: dict[str, str]) -> DataFrame:
    """Unnest parallel arrays by ordinal position.

    ``arrays`` maps array column -> element name.  Positions beyond the
    shortest array are dropped (equal ordinals only), as when two
    ``unnest ... with ordinality`` are matched on their index."""
    names = list(arrays)
    n = F.size(names[0]) if len(names) == 1 else F.least(*[F.size(a) for a in names])
    zipped = F.slice(F.arrays_zip(*names), F.lit(1), F.greatest(n, F.lit(0)))
    out = df.select(*keep, F.posexplode(zipped).alias("_pos", "_e"))
    return out.select(
        *keep,
        (F.col("_pos") + 1).cast("bigint").alias("idx"),
        *[F.col("_e")[a].alias(v) for a, v in arrays.items()],
    )
