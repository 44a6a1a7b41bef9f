"""Text expressions with the word rules of the analytics SQL being replaced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the marker a NULL component gets inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def initcap_words(c: Column | str) -> Column:
    """Capitalise every run of letters/digits ("d'oeste" -> "D'Oeste");
    Spark's own ``initcap`` only breaks words at blanks."""
    c = F.col(c) if isinstance(c, str) else c
    runs = F.regexp_extract_all(
        F.lower(c), F.lit("([\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+)"), F.lit(0)
    )
    cap = F.transform(
        runs, lambda w: F.concat(F.upper(w.substr(1, 1)), w.substr(F.lit(2), F.length(w)))
    )
    return F.array_join(cap, "")


def surrogate_key(*cols: str) -> Column:
    """md5 over the NULL-safe text of ``cols`` joined by '-'."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def month_label(ts: Column | str) -> Column:
    """English month name blank-padded to nine characters."""
    return F.rpad(F.date_format(ts, "MMMM"), 9, " ")


def pad_zip(c: Column | str) -> Column:
    """Zip prefix as five-character text (restores leading zeros)."""
    c = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.when(F.length(c) < 5, F.lpad(c, 5, "0")).otherwise(c)
