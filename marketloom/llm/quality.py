"""Quality by weak supervision, in DataFrame functions only.

Every document is measured once (``measure``).  Rules vote good, bad or
abstain on the measures (``votes``).  Expectation-maximisation over the table of
vote patterns and their counts, at most 3 ** rules rows for any number of
documents, estimates how often rules vote what on good and on bad documents
(``fit``), without any label.  The posterior probability of a good document
follows from the votes (``judge``) and replaces all-must-pass filters.

Rules that look at one kind of damage are a family.  Its k rules tend to agree, so
their log odds count by 1 / sqrt(k) each: more than one witness, less than k.  A
bad vote never speaks for good, nor a good one for bad, so the classes cannot
change places; a rule that abstains says nothing.  Texts that another filter rejects
anyway are left out of the fit (``fitted``); they would make a class of their own.

Nulls: a null text has no words; every ratio over nothing is null and the rule
abstains.  Empty tables give no rows and the starting accuracies.  Repeated
rows are judged as often as they occur; ties cannot occur.  Only the id and the
text are read, so extra columns of any name do no harm.

Three-word windows are compared by 64-bit hashes of their words."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.sources.tables import write_scratch

GOOD, BAD, ABSTAIN = 1, -1, 0

#: White space between words, and the symbols counted.
SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
SYMBOL_PATTERNS = {
    "ends": r"[#*$%&|<>](?![^\x20\x09-\x0D])",
    "runs": r"([#*$%&|<>])\1\1",
    "words": r"(?<![^\x20\x09-\x0D])[#*$%&|<>]++(?![^\x20\x09-\x0D])",
}


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words covered by a three-word window found twice or more in ``words``."""

    def covered(w: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                i.alias("i"),
            ),
        )

        def repeated(s: Column) -> Column:
            h = lambda k: F.get(s, k)["h"]
            marked = F.transform(
                s,
                lambda x, k: F.when(
                    (x["h"] == h(k - 1)) | (x["h"] == h(k + 1)), x["i"]
                ),
            )
            return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

        # a window covers up to three words that the window before it did not
        state = F.aggregate(
            bind(F.sort_array(windows), repeated),
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda a, i: F.struct(
                i.alias("last"),
                (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"),
            ),
        )
        return F.when(F.size(w) >= 4, state["n"]).otherwise(F.lit(0).cast("long"))

    return covered(words)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every text: id, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_ended_lines, n_repeat_words, n_upper, n_chars, and of words that end in a
    symbol, runs of three equal symbols, and words of symbols only
    (n_symbol_ends, n_symbol_runs, n_symbol_words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    length = lambda c: F.char_length(c).cast("long")
    without = lambda c, chars: F.translate(c, chars, "")
    one = docs.select(F.col(id_col).alias("id"), text.alias("t"))
    words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")
    )
    lines = lambda s: F.struct(
        F.size(s).cast("long").alias("n_lines"),
        (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(s, lambda x: F.rtrim(x).rlike("[.!?…][\"')]*$"))).cast("long")
        .alias("n_ended_lines"),
    )
    trimmed = F.btrim("t", F.lit(SPACE))
    split = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    )
    full = F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    return one.select(
        "id",
        bind(split, words).alias("w"),
        bind(full, lines).alias("l"),
        length(F.col("t")).alias("n_chars"),
        length(without(F.col("t"), SPACE)).alias("word_chars"),
        length(without(F.col("t"), SYMBOLS)).alias("_no_symbols"),
        length(without(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("_no_upper"),
        *[F.regexp_count("t", F.lit(p)).cast("long").alias(f"n_symbol_{name}") for name, p in SYMBOL_PATTERNS.items()],
    ).select(
        "id", "w.*", "l.*", "n_chars", "word_chars",
        (F.col("n_chars") - F.col("_no_symbols")).alias("n_symbols"),
        (F.col("n_chars") - F.col("_no_upper")).alias("n_upper"),
        *[f"n_symbol_{name}" for name in SYMBOL_PATTERNS],
    )


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good`` and bad beyond ``bad`` of a ratio (the other
    way round where ``good`` is the larger), else abstains."""

    name: str
    family: str
    over: str
    under: str
    good: float
    bad: float

    def vote(self) -> Column:
        ratio = F.try_divide(F.col(self.over).cast("double"), F.col(self.under).cast("double"))
        low = self.good < self.bad
        good = ratio <= self.good if low else ratio >= self.good
        bad = ratio > self.bad if low else ratio < self.bad
        return F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


RULES = (
    Rule("symbols", "symbols", "n_symbols", "word_chars", 0.02, 0.06),
    Rule("symbol_ends", "symbols", "n_symbol_ends", "n_words", 0.05, 0.2),
    Rule("symbol_runs", "symbols", "n_symbol_runs", "n_words", 0.02, 0.1),
    Rule("symbol_words", "symbols", "n_symbol_words", "n_words", 0.02, 0.15),
    Rule("repeated_lines", "repetition", "n_dup_lines", "n_lines", 0.1, 0.3),
    Rule("repeated_words", "repetition", "n_repeat_words", "n_words", 0.15, 0.35),
    Rule("capitals", "capitals", "n_upper", "word_chars", 0.1, 0.3),
    Rule("long_words", "words", "word_chars", "n_words", 8.0, 12.0),
    Rule("short_words", "words", "word_chars", "n_words", 3.5, 2.5),
    Rule("ended_lines", "lines", "n_ended_lines", "n_lines", 0.7, 0.2),
)


def families(rules) -> dict[str, list[Rule]]:
    out: dict[str, list[Rule]] = {}
    for rule in rules:
        out.setdefault(rule.family, []).append(rule)
    return out


@dataclass(frozen=True)
class Model:
    """Log of P(vote | good) / P(vote | bad) by rule and vote, tempered by family,
    and the prior's."""

    prior: float
    weight: dict[str, dict[int, float]]

    def posterior(self) -> Column:
        """Probability of a good document, from the vote columns."""
        total = F.lit(self.prior)
        for name, by_vote in self.weight.items():
            column = F.col(f"vote_{name}")
            total = total + F.when(column == GOOD, by_vote[GOOD]).when(
                column == BAD, by_vote[BAD]
            ).otherwise(by_vote[ABSTAIN])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def votes(measured: DataFrame, rules=RULES) -> DataFrame:
    return measured.select("*", *[r.vote().alias(f"vote_{r.name}") for r in rules])


def fit(voted: DataFrame, rules=RULES, rounds: int = 30, pseudo: float = 1.0) -> Model:
    """Expectation-maximisation over the counted vote patterns.

    It starts from the belief that a document with a bad vote is bad and ends
    with each rule's rates of good and bad votes in both classes.  ``pseudo`` documents
    of the average kind are added to each class, so that a rule without
    evidence in a small class says little."""
    columns = [f"vote_{r.name}" for r in rules]
    patterns = sorted(
        (tuple(row[c] for c in columns), row["n"])
        for row in voted.groupBy(*columns).agg(F.count("*").alias("n")).collect()
    )
    temper = {f: 1 / math.sqrt(len(group)) for f, group in families(rules).items()}
    belief = [0.1 if BAD in p else 0.9 for p, _ in patterns]
    prior, weight = 0.0, {r.name: dict.fromkeys((GOOD, BAD, ABSTAIN), 0.0) for r in rules}
    for _ in range(rounds):
        good = sum(q * n for q, (_, n) in zip(belief, patterns)) + pseudo
        bad = sum((1 - q) * n for q, (_, n) in zip(belief, patterns)) + pseudo
        prior = math.log(good / bad)
        for j, rule in enumerate(rules):
            for v, bound in ((GOOD, max), (BAD, min)):
                on_good = sum(q * n for q, (p, n) in zip(belief, patterns) if p[j] == v)
                on_bad = sum((1 - q) * n for q, (p, n) in zip(belief, patterns) if p[j] == v)
                share = pseudo * (on_good + on_bad) / (good + bad - 2 * pseudo or 1)
                if share:
                    odds = math.log((on_good + share) / good) - math.log((on_bad + share) / bad)
                    weight[rule.name][v] = bound(0.0, odds) * temper[rule.family]
        belief = [
            1 / (1 + math.exp(-max(-500.0, prior + sum(weight[r.name][v] for r, v in zip(rules, p)))))
            for p, _ in patterns
        ]
    return Model(prior, weight)


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
    threshold: float = 0.5, fitted: Column | None = None,
) -> DataFrame:
    """The measures, ``vote_`` columns, ``posterior`` and ``good`` of every document;
    ``fitted`` (on the measures) says which texts the model is fitted on."""
    measured = write_scratch(votes(measure(docs, id_col, text_col), rules), "quality")
    p = fit(measured if fitted is None else measured.filter(fitted), rules).posterior()
    return measured.withColumnRenamed("id", id_col).withColumns(
        {"posterior": p, "good": p >= threshold}
    )
