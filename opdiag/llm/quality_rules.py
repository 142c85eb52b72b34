"""Quality rules: learned decision lists over text statistics, as Spark expressions.

``statistics`` derives numbers from a text with built-in expressions. ``learn`` covers the labelled
rows step by step: a rule for low quality is grown on two thirds of the rows, by the threshold that
gains most information at each step, then pruned on the other third, and the rows it covers are set
aside. All counting is done by aggregates over the statistics of every labelled row; the driver only
sees counts per threshold. The list becomes one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opdiag.session import scratch_path

WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"
BLANK = "[\\x20\\x09-\\x0D]+"

#: Thresholds tried per feature, at even quantiles of the labelled rows.
CUTS = 24
MAX_RULES = 12
MAX_CONDITIONS = 4
#: A rule must be right on this share of the pruning rows it covers, and cover so many rows.
MIN_PRECISION = 0.9
MIN_COVERED = 5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda word: word != "")


def _repeat_words(words: Column) -> Column:
    """Words inside windows of five words that the text has twice or more.

    Windows are named by 64-bit hashes. Sorted by name and place, a repeated window has an equal
    neighbour; the places that remain, sorted again, each cover what the next one does not.
    """
    count = F.size(words)

    def windows(text: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(text) - WINDOW),
            lambda at: F.struct(
                F.xxhash64(*[F.get(text, at + step) for step in range(WINDOW)]).alias("name"),
                at.alias("place"),
            ),
        )

    def repeated(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda one, at: (one["name"] == F.get(ordered, at - 1)["name"])
            | (one["name"] == F.get(ordered, at + 1)["name"]),
        )
        places = F.sort_array(F.transform(same, lambda one: one["place"]))
        return let(places, covered)

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(
                places,
                lambda place, at: F.least(
                    F.lit(WINDOW), F.coalesce(F.get(places, at + 1) - place, F.lit(WINDOW))
                ),
            ),
            F.lit(0).cast("long"), lambda total, part: total + part,
        )

    def some(named: Column) -> Column:
        names = F.transform(named, lambda one: one["name"])
        return F.when(F.size(F.array_distinct(names)) == F.size(named), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(named), repeated)
        )

    return F.when(count <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows(words), some))


def statistics(text: Column) -> Column:
    """Struct of ``COUNTS`` for a text; a null text has zeros.

    Words are runs of anything but ASCII white space, ``word_chars`` their code points,
    ``n_symbols`` the characters of ``SYMBOLS``, ``n_dup_lines`` the lines with a word that equal an
    earlier line, ``n_repeat_words`` the words in five-word windows found twice or more.
    """
    whole = F.coalesce(text, F.lit(""))

    def from_words(words: Column) -> Column:
        chars = F.aggregate(words, F.lit(0).cast("long"), lambda total, word: total + F.length(word))
        return F.struct(
            F.size(words).cast("long").alias("n_words"), chars.alias("word_chars"),
            (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long")
            .alias("n_symbols"),
            _duplicate_lines(whole).alias("n_dup_lines"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    return let(_words(whole), from_words)


def _duplicate_lines(text: Column) -> Column:
    filled = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    return let(filled, lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        100 * stats["n_repeat_words"] > MAX_REPEATED_PERCENT * stats["n_words"]
    )


def features(stats: Column) -> dict[str, Column]:
    """Numbers that conditions compare; ratios of a text without words are 0."""
    words = F.greatest(stats["n_words"], F.lit(1))
    return {
        "n_words": stats["n_words"].cast("double"),
        "word_length": stats["word_chars"] / words,
        "symbols_per_word": stats["n_symbols"] / words,
        "dup_lines_per_word": stats["n_dup_lines"] / words,
        "repeated_share": stats["n_repeat_words"] / words,
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, values: dict[str, Column]) -> Column:
        value = values[self.feature]
        return value > F.lit(self.cut) if self.above else value <= F.lit(self.cut)


@dataclass(frozen=True)
class Rule:
    """Texts that meet all conditions are of low quality."""

    conditions: tuple[Condition, ...]

    def holds(self, values: dict[str, Column]) -> Column:
        met = F.lit(True)
        for condition in self.conditions:
            met = met & condition.holds(values)
        return met


def verdict(rules: list[Rule], values: dict[str, Column]) -> Column:
    """True if no rule of the list rejects the text: the first rule that holds decides."""
    decided = None
    for rule in rules:
        met = rule.holds(values)
        decided = F.when(met, False) if decided is None else decided.when(met, False)
    return F.lit(True) if decided is None else decided.otherwise(True)


def _gain(bad: int, good: int, all_bad: int, all_good: int) -> float:
    """Information gained on the low-quality rows that a condition keeps."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(all_bad / (all_bad + all_good)))


def _cuts(rows: DataFrame, names: list[str]) -> dict[str, list[float]]:
    shares = [at / CUTS for at in range(1, CUTS)]
    found = rows.agg(*[
        F.percentile_approx(F.col(name), shares, 10_000).alias(name) for name in names
    ]).first()
    cuts = {name: set(found[name] or ()) for name in names}
    low = rows.filter("low").agg(*[
        F.percentile_approx(F.col(name), shares, 10_000).alias(name) for name in names
    ]).first()
    return {name: sorted(cuts[name] | set(low[name] or ())) for name in names}


def _tally(rows: DataFrame, conditions: list[Condition], values: dict[str, Column]) -> dict:
    """Low and other rows that meet each condition, in one aggregate; and of all rows."""
    sums = [F.sum(F.col("low").cast("long")).alias("low"), F.count(F.lit(1)).alias("all")]
    for at, condition in enumerate(conditions):
        met = condition.holds(values)
        sums += [F.count(F.when(met & F.col("low"), 1)).alias(f"low{at}"),
                 F.count(F.when(met, 1)).alias(f"all{at}")]
    found = rows.agg(*sums).first()
    total = found["low"] or 0, found["all"] - (found["low"] or 0)
    return {"total": total, "each": [
        (found[f"low{at}"], found[f"all{at}"] - found[f"low{at}"]) for at in range(len(conditions))
    ]}


def _grown(rows: DataFrame, cuts: dict[str, list[float]], values: dict[str, Column]) -> Rule | None:
    tried = [Condition(name, above, cut) for name, all_cuts in cuts.items()
             for cut in all_cuts for above in (True, False)]
    chosen: list[Condition] = []
    while len(chosen) < MAX_CONDITIONS:
        covered = rows.filter(Rule(tuple(chosen)).holds(values))
        tally = _tally(covered, tried, values)
        all_low, all_good = tally["total"]
        if not all_low or not all_good:
            break
        gains = [_gain(low, good, all_low, all_good) for low, good in tally["each"]]
        best = max(range(len(tried)), key=lambda at: (gains[at], -at))
        if gains[best] <= 1e-9:
            break
        chosen.append(tried[best])
    return Rule(tuple(chosen)) if chosen else None


def _pruned(rule: Rule, rows: DataFrame, values: dict[str, Column]) -> tuple[Rule, int, int]:
    """The leading conditions that do best on the pruning rows, and the rows they cover."""
    shorter = [Rule(rule.conditions[:size]) for size in range(1, len(rule.conditions) + 1)]
    sums = []
    for at, one in enumerate(shorter):
        met = one.holds(values)
        sums += [F.count(F.when(met & F.col("low"), 1)).alias(f"low{at}"),
                 F.count(F.when(met, 1)).alias(f"all{at}")]
    found = rows.agg(*sums).first()
    counts = [(found[f"low{at}"], found[f"all{at}"] - found[f"low{at}"]) for at in range(len(shorter))]

    def worth(at: int) -> tuple[float, int]:
        low, good = counts[at]
        return ((low - good) / (low + good) if low + good else -1.0, -at)

    best = max(range(len(shorter)), key=worth)
    return shorter[best], *counts[best]


def learn(labelled: DataFrame) -> list[Rule]:
    """Decision list from rows of ``stats`` (struct of ``COUNTS``), ``low`` (boolean), ``part``.

    ``part`` is 0 for pruning rows and 1 or 2 for growing ones. Rows with a null ``low`` are left
    out. Without low or without other rows the list is empty and rejects nothing.
    """
    values = features(F.col("stats"))
    names = list(values)
    rows = labelled.filter("low is not null").select(
        "low", "part", *[value.alias(name) for name, value in values.items()]
    )
    values = {name: F.col(name) for name in names}
    cuts = _cuts(rows, names)
    rules: list[Rule] = []
    left = rows
    while len(rules) < MAX_RULES:
        rule = _grown(left.filter("part <> 0"), cuts, values)
        if rule is None:
            break
        rule, low, good = _pruned(rule, left.filter("part = 0"), values)
        if low + good < MIN_COVERED or low < MIN_PRECISION * (low + good):
            break
        rules.append(rule)
        left = left.filter(~rule.holds(values))
    return rules


def judged(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    quality_col: str = "quality",
) -> DataFrame:
    """``id, COUNTS, base_failed, kept`` per row of ``docs``.

    ``labels`` has the same id column and 1 for good, 0 for low quality. The statistics of all rows
    are written to the shared folder once; training joins them with the labels by id, so that a
    repeated label counts as often as it is given. Rows without an id are judged but not learned
    from. Without usable labels only the base rules reject.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "statistics")
    docs.select(
        F.col(id_col).cast("long").alias("id"), statistics(F.col(text_col)).alias("stats")
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    known = labels.select(
        F.col(id_col).cast("long").alias("id"), (F.col(quality_col) == 0).alias("low")
    ).filter("low is not null")
    path = scratch_path(spark, "labelled")
    rows.join(known, "id").filter(~base_failed(F.col("stats"))).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.lit(3))
    ).write.parquet(path)
    rules = learn(spark.read.parquet(path))
    stats = F.col("stats")
    failed = base_failed(stats)
    return rows.select(
        "id", *[stats[name].alias(name) for name in COUNTS], failed.alias("base_failed"),
        (~failed & verdict(rules, features(stats))).alias("kept"),
    )
