"""Column expressions: cleanup, id lists, shingles, n-grams, comparisons, F-beta."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for no id in a list of ids.
NO_ID = ("", "nan", "none", "null", "na", "n/a", "[]", "()", "{}")


def squeezed(c: Column) -> Column:
    """Null is empty; runs of white space are one space; none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def joined(parts: list[Column], join: str = ", ") -> Column:
    """Parts joined, without the separators that empty parts leave."""
    mark = join.strip() or " "
    text = F.lit("")
    for i, p in enumerate(parts):
        text = squeezed(p) if i == 0 else F.concat(text, F.lit(join), squeezed(p))
    if len(parts) < 2:
        return text
    text = F.regexp_replace(text, rf"(\s*\Q{mark}\E\s*)+", join)
    return F.trim(F.regexp_replace(F.trim(text), rf"^(\Q{mark}\E)+|(\Q{mark}\E)+$", ""))


def id_list(c: Column, sep: str = ",") -> Column:
    """Ids of a list in any of the usual spellings, each once, in order."""
    text = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    bare = F.regexp_replace(text, r"^(?:\[(.*)\]|\((.*)\)|\{(.*)\})$", "$1$2$3")
    parts = F.transform(F.split(bare, rf"\Q{sep}\E"), lambda x: F.trim(F.regexp_replace(F.trim(x), r"^['\"]+|['\"]+$", "")))
    return F.array_distinct(F.filter(parts, lambda x: ~F.lower(x).isin(*NO_ID)))


def list_style(c: Column) -> Column:
    """Aggregate: how most non-blank lists are written."""
    text = F.trim(c.cast("string"))
    some = F.when(text != "", (text.startswith("[") & text.endswith("]")).cast("int"))
    return F.when(F.coalesce(F.avg(some), F.lit(0.0)) > 0.5, "bracketed").otherwise("plain")


def style_of(style: str, ids: Column, sep: str = ",") -> Column:
    return F.concat(F.lit("["), F.array_join(ids, ", "), F.lit("]")) if style == "bracketed" else F.array_join(ids, sep)


def words(c: Column) -> Column:
    return F.array_remove(F.split(c, " "), "")


def slices(c: Column, n: int) -> Column:
    """All runs of n characters; a shorter text is one run, an empty one none."""
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))


def shingles(c: Column, k: int = 3) -> Column:
    """CRC-32 of the distinct runs of k characters."""
    return F.transform(F.array_distinct(slices(c, k)), lambda x: F.crc32(F.encode(x, "utf-8")))


def word_grams(c: Column, low: int = 2, high: int = 4) -> Column:
    """Character n-grams of each word with a blank on both sides; a word shorter than n gives itself once."""

    def of(w: Column) -> Column:
        p = F.concat(F.lit(" "), w, F.lit(" "))
        sizes = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: (n == low) | (F.length(p) >= n))
        return F.flatten(F.transform(sizes, lambda n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(p) - n + 1, F.lit(1))), lambda i: F.substring(p, i, n))))

    return F.flatten(F.transform(words(c), of))


def common_prefix(a: Column, b: Column) -> Column:
    upto = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.array_max(F.filter(upto, lambda n: F.substring(a, F.lit(1), n) == F.substring(b, F.lit(1), n)))


def same(a: Column, b: Column) -> Column:
    """1.0 or 0.0; null where either side is empty."""
    return F.when((a == "") | (b == ""), F.lit(None)).otherwise((a == b).cast("double"))


def ifboth(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") | (b == ""), F.lit(None)).otherwise(value)


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("double")


def levenshtein_similarity(a: Column, b: Column) -> Column:
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def fbeta(tp: Column, predicted: Column, true: Column, beta: float = 0.5) -> Column:
    """F-beta of a set; two empty sets agree."""
    b = beta * beta
    whole = b * true + predicted
    return F.when(whole == 0, F.lit(1.0)).otherwise((1 + b) * tp / F.when(whole == 0, F.lit(1)).otherwise(whole))


def logit(p: Column, edge: float = 1e-6) -> Column:
    q = F.least(F.greatest(p, F.lit(edge)), F.lit(1 - edge))
    return F.log(q / (1 - q))
