"""Quality rules with risk-controlled thresholds, in DataFrame expressions only.

Base rules are fixed.  Beyond them, ``RULES`` reject a document whose value is
above a cutoff.  Their cutoffs form levels, fixed beforehand, from lenient to
strict: what a level rejects, the next rejects too.  Each stratum (language) has
a level of its own, chosen from labelled documents.  Let n be the good documents
of the stratum that pass the base rules and k those that some rule would reject
at a level.  The level is safe if a false rejection rate of ``risk`` would give k
or fewer rejections with probability at most ``error`` divided by the number of
strata: an exact binomial bound.  Levels are tested from the most lenient on,
until one is not safe; the last safe one is used, and none if the first fails.

The guarantee.  With probability 1 - ``error`` no stratum loses more than a share
``risk`` of its good documents to these rules.  For a stratum, let m be the first
level whose true rate is above ``risk``; rates rise with the level, so the choice
is wrong only if level m was found safe, which has probability ``error / strata``
at most.  So the tests within a stratum need no correction among each other
(fixed-sequence testing), and those of the strata are corrected by Bonferroni.
With four strata and the defaults the first level needs 217 good documents of
which it rejects none, 306 with one rejected.

Counts for all documents are made in one pass and stored narrow; texts are
never shuffled.  Repeated five-word windows are found within a row by a 64-bit
hash of each window.

Defined results: null texts have no word and fail; a null stratum is a stratum
of its own; labels without a document and documents without a label teach
nothing, repeated labels and rows count each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import SPACE_CHARS, stored

SYMBOLS = "#*$%&|<>"
WINDOW = 5


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS)), " "), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; a lambda would compute what it refers to for every element."""
    return F.transform(F.array(value), body)[0]


def shifted(a: Column) -> Column:
    return F.slice(a, 2, F.size(a))


def repeated_words(words: Column, n: int = WINDOW) -> Column:
    """How many words stand in windows of n words that are found twice or more."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(n))))

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twins = lambda s: F.flatten(F.zip_with(s, shifted(s), lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i)).otherwise(F.array().cast("array<int>"))))
        places = let(placed, lambda s: F.sort_array(F.array_distinct(twins(s))))
        steps = let(places, lambda p: F.zip_with(p, shifted(p), lambda a, b: F.coalesce(F.least(b - a, F.lit(n)), F.lit(n))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), lambda x, y: x + y))

    return F.when(F.size(words) <= n, F.lit(0)).otherwise(let(windows, covered))


def measures(docs: DataFrame, stratum: str | None = "lang") -> DataFrame:
    """doc_id, th, stratum and the counts of each document."""
    text = F.coalesce("text", F.lit(""))
    stratum = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), stratum.alias("stratum"), text.alias("t")).withColumn("words", words_of(F.col("t")))
    full = F.filter(F.split("t", "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    rows = rows.withColumn("full", full)
    return rows.select(
        "doc_id",
        "th",
        "stratum",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("full").cast("long").alias("n_full_lines"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Rule:
    """Rejects where ``value`` (a ratio, SQL over the counts) is above the cutoff of the level; from lenient to strict."""

    name: str
    value: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "n_symbols / n_words", (0.4, 0.3, 0.2, 0.15, 0.1, 0.07, 0.05)),
    Rule("duplicate_lines", "n_dup_lines / n_full_lines", (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("repeated_words", "n_repeat_words / n_words", (0.19, 0.17, 0.15, 0.13, 0.1, 0.08, 0.05)),
    Rule("long_words", "word_chars / n_words", (13.0, 12.0, 11.0, 10.5, 10.0, 9.0, 8.0)),
    Rule("short_words", "-word_chars / n_words", (-1.8, -2.2, -2.6, -3.0, -3.3, -3.5, -4.0)),
)


def first_level(rules: tuple[Rule, ...] = RULES) -> Column:
    """The most lenient level at which some rule rejects; null if none does."""

    def of(r: Rule) -> Column:
        value = F.try_divide(*map(F.expr, r.value.split(" / ")))
        out = F.when(value > r.cutoffs[0], 0)
        for j, c in enumerate(r.cutoffs[1:], 1):
            out = out.when(value > c, j)
        return out

    return F.least(*map(of, rules)) if len(rules) > 1 else of(rules[0])


def log_factorial(x: Column) -> Column:
    """ln x!, by Stirling's series at x + 8."""
    z = x + F.lit(8.0)
    series = (z - 0.5) * F.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    product = F.lit(1.0)
    for j in range(1, 8):
        product = product * (x + F.lit(float(j)))
    return series - F.log(product)


TERMS = 1000


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of a binomial with n trials; 1 where k is at or above the mean.

    Terms fall from k downwards by a factor below the first one's, so beyond
    ``TERMS`` of them a geometric series bounds the rest from above: the tail is
    never found smaller than it is, and the work does not grow with the labels.
    """
    first = F.exp(log_factorial(n) - log_factorial(k) - log_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p)))
    ratio = lambda i: i * (1 - p) / ((n - i + 1) * p)  # noqa: E731  (of the terms i - 1 and i)
    start = F.struct(F.lit(0.0).alias("sum"), first.alias("term"))
    step = lambda a, j: F.struct((a.sum + a.term).alias("sum"), (a.term * ratio(k - j)).alias("term"))
    total = F.aggregate(F.sequence(F.lit(0).cast("long"), F.least(k, F.lit(TERMS).cast("long"))), start, step)
    return F.when(k >= n * p, F.lit(1.0)).otherwise(total.sum + F.when(k > TERMS, total.term / (1 - ratio(k - TERMS))).otherwise(0.0))


def calibrate(counts: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """stratum, level (the strictest safe one), n (good documents), k (rejected by each level); strata without a safe level are left out."""
    good = counts.filter(~base_failed()).join(labels.filter("quality = 1").select("doc_id"), "doc_id").withColumn("at", first_level(rules))
    levels = len(rules[0].cutoffs)
    sums = good.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col("at") <= j).alias(f"k{j}") for j in range(levels)))
    known = stored(sums, "quality-labels")  # one row a stratum
    tests = max(1, known.count())
    level = F.lit(levels - 1)
    for j in reversed(range(levels)):
        level = F.when(binomial_tail(F.col("n").cast("double"), F.col(f"k{j}"), risk) > error / tests, j - 1).otherwise(level)
    return known.select("stratum", level.alias("level"), "n", F.array(*(f"k{j}" for j in range(levels))).alias("k")).filter("level >= 0")


def judged(counts: DataFrame, levels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``counts`` with base_failed and kept."""
    above = F.coalesce(first_level(rules) <= F.col("level"), F.lit(False))
    return counts.join(levels.select("stratum", "level"), "stratum", "left").select(*counts.columns, base_failed().alias("base_failed"), (~base_failed() & ~above).alias("kept"))


def quality(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """doc_id, th (hash of the text), the counts, base_failed, kept."""
    counts = stored(measures(docs, stratum), "quality-counts")
    return judged(counts, calibrate(counts, labels, RULES, risk, error))


def kept_documents(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; rows are known by id and text."""
    bad = quality(docs, labels, stratum, risk, error).filter(~F.col("kept")).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th")).distinct()
    at, names = docs.columns.index("doc_id"), [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    return rows.join(bad, F.col(names[at]).eqNullSafe(F.col("__id")) & (F.xxhash64(names[docs.columns.index("text")]) == F.col("__th")), "left_anti").toDF(*docs.columns)
