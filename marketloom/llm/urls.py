"""URL verdicts: explicit rules first, gradient-boosted trees for the rest.

A rule names a host and the start of a path; the longest rule that fits a URL
decides.  URLs that a rule decides are the labelled ones; the trees are trained
on lexical features of a bounded, hash-chosen sample of them, half of each label, and
judge all URLs without a rule.  Everything is DataFrame functions and MLlib on DataFrames.

Features: length, depth, digit ratio, character entropy, parameter count, host
labels and hyphens, and the smoothed share of allowed URLs among the labelled
ones of the host's suffix (its last label, and its last two).

Nulls: a null URL or one without "://" has an empty host and path, fits no rule
and is judged by the trees on empty features.  Without labelled URLs of both
kinds every URL gets the one label known, or allow.  Repeated rows are judged
alike.  Ties: rules of one length differ in text, and at most one path-start of
a length fits a host; on equal length the first in text order decides.  Only the
id and the URL are read, so extra columns of any name do no harm."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.sources.tables import write_scratch

#: Labelled URLs the trees are trained on, at most about so many.
TRAINING_URLS = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = [
    "url_length", "host_length", "path_length", "depth", "digit_ratio", "entropy",
    "parameters", "labels", "hyphens", "suffix_rate", "domain_rate",
]


@dataclass(frozen=True)
class Rule:
    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL (both empty without "://")."""
    after = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, "(?s)^.*?://(.*)$", 1))
    host = F.translate(F.regexp_extract(after, "(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(after, "(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Index into the ordered rules (see ``ordered``) of the first that fits."""
    found = None
    for i, rule in enumerate(ordered(rules)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, i) if found is None else found.when(fits, i)
    return F.lit(None).cast("int") if found is None else found


def ordered(rules: list[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r.text), r.text))


def entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.char_length(text)
    counts = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: n - F.char_length(F.replace(text, c, F.lit("")))
    )
    bits = F.aggregate(counts, F.lit(0.0), lambda a, k: a + F.when(k > 0, k * F.log2(k)).otherwise(0.0))
    return F.when(n > 0, F.log2(n.cast("double")) - bits / n).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """Adds the features of ``url``, ``host`` and ``path`` and the suffix columns."""
    url = F.coalesce("url", F.lit(""))
    count = lambda c, chars: F.char_length(c) - F.char_length(F.translate(c, chars, ""))
    query = F.regexp_extract(url, "(?s)\\?([^#]*)", 1)
    numbers = {
        "url_length": F.char_length(url),
        "host_length": F.char_length("host"),
        "path_length": F.char_length("path"),
        "depth": count(F.col("path"), "/"),
        "digit_ratio": F.coalesce(
            F.try_divide(count(url, "0123456789").cast("double"), F.char_length(url).cast("double")),
            F.lit(0.0),
        ),
        "entropy": entropy(url),
        "parameters": F.when(query != "", count(query, "&") + 1).otherwise(0),
        "labels": count(F.col("host"), "."),
        "hyphens": count(F.col("host"), "-"),
    }
    return urls.withColumns({k: v.cast("double") for k, v in numbers.items()}).withColumns({
        "suffix": F.substring_index("host", ".", -1),
        "domain": F.substring_index("host", ".", -2),
    })


def _rates(labelled: DataFrame, key: str, rate: str, overall: float) -> DataFrame:
    return labelled.groupBy(key).agg(
        ((F.sum("label") + 10 * overall) / (F.count("*") + 10)).alias(rate)
    )


def judge_urls(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
    training_urls: int = TRAINING_URLS, trees: int = 10, depth: int = 3,
) -> DataFrame:
    """id, host, path, rule (text or null), verdict and the trees' probability."""
    rules = ordered(rules)
    host, path = parts(F.col("url"))
    urls = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns(
        {"host": host, "path": path}
    )
    index = longest_rule(F.col("host"), F.col("path"), rules)
    allowed = [i for i, r in enumerate(rules) if r.allow]
    urls = urls.withColumn("rule_no", index).withColumn(
        "label", F.when(F.col("rule_no").isNotNull(), F.col("rule_no").isin(allowed).cast("double"))
    )
    known = write_scratch(lexical(urls), "urls")
    labelled = known.filter(F.col("label").isNotNull())
    n, n_allowed = labelled.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    overall = n_allowed / n if n else 1.0
    for key, rate in (("suffix", "suffix_rate"), ("domain", "domain_rate")):
        known = known.join(_rates(labelled, key, rate, overall), key, "left").fillna(
            overall, [rate]
        )
    if not 0 < n_allowed < n:
        judged = known.withColumn("probability", F.lit(overall))
    else:
        ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(known)
        # half of the sample for each label, by a hash of 62 bits, and one row at least
        draw = F.pmod(F.xxhash64("url"), F.lit(1 << 62))
        least = dict(known.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min(draw)).collect())
        chosen = F.lit(False)
        for label, rows in ((1.0, n_allowed), (0.0, n - n_allowed)):
            limit = max(least[label], int(min(1.0, training_urls / 2 / rows) * ((1 << 62) - 1)))
            chosen = chosen | ((F.col("label") == label) & (draw <= F.lit(limit)))
        # repeated URLs have one hash: each counts once
        train = ready.filter(chosen).dropDuplicates(["url"]).select("label", "features")
        model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7).fit(
            write_scratch(train, "url-training")
        )
        judged = model.transform(ready).withColumn(
            "probability", F.get(vector_to_array("probability"), F.lit(1))
        )
    texts = F.array(*[F.lit(r.text) for r in rules]) if rules else F.array().cast("array<string>")
    decided = F.coalesce("label", F.when(F.col("probability") >= 0.5, 1.0).otherwise(0.0))
    return judged.select(
        F.col("id").alias(id_col), "host", "path",
        F.get(texts, F.col("rule_no")).alias("rule"),
        F.when(decided == 1.0, "allow").otherwise("block").alias("verdict"),
        "probability",
    )
