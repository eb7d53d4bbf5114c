"""Quality rules: a threshold table compiled into one Spark projection.

``RULES`` is the table: each row names a ratio of the counted features, the allowed range
and from how many words on it applies. ``features`` counts words, symbols, stop words
and lines with built-in functions only; ``verdict`` turns the table into one boolean
column. There is no user function and no shuffle.

Null texts count as empty: no words, base_failed, not kept. Words are
``[^\\x20\\x09-\\x0D]+``; code points are counted as characters; lines end at ``\\n``.
Repeated rows are judged alike; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that it for was on are as with be by this at from or an a have not they which "
    "le la les de des du et en un une est que qui dans pour par sur au avec ce pas plus "
    "der die das und von zu den mit ist im für auf dem ein eine nicht als auch sich werden "
    "el los las que y del se por con para una su al lo como más pero o"
).split()

STOP_FORMS = [form for w in STOP_WORDS for form in (w, w.capitalize())]

#: (feature, per, least, most, from how many words). A text fails when feature / per is outside.
RULES = (
    ("word_chars", "n_words", 2.0, 12.0, 50),
    ("n_symbols", "n_words", None, 0.10, 50),
    ("n_stop_words", "n_words", 0.02, None, 50),
    ("n_dup_lines", "n_lines", None, 0.50, 50),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def _spaced(text: Column) -> Column:
    """The text with every white space character turned into one space."""
    for space in "\t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


#: With up to so many repeated window hashes, windows are looked up before they are sorted.
FEW = 32


def _repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more. Only windows whose 64-bit hash
    occurs twice can repeat; those are sorted as strings with their places, equal neighbours
    mark the repeated ones, and their places cover the words."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    spelled = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    hashes = F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def covered(places: Column) -> Column:
        return F.aggregate(F.transform(places, lambda x, k: F.coalesce(
            F.least(F.lit(3), F.get(places, k + 1) - x), F.lit(3)).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(windows: Column) -> Column:
        return F.transform(F.filter(windows, lambda x, k: (
            (F.get(windows, k - 1)["w"] == x["w"]) | (F.get(windows, k + 1)["w"] == x["w"]))), lambda x: x["i"])

    def among(h: Column) -> Column:
        def exact(twice: Column) -> Column:
            maybe = F.when(F.size(twice) <= FEW, F.filter(at, lambda i: F.array_contains(twice, F.get(h, i)))).otherwise(at)
            windows = F.sort_array(F.transform(maybe, lambda i: F.struct(spelled(i).alias("w"), i.alias("i"))))
            return bind(windows, lambda s: bind(F.sort_array(repeated(s)), covered))

        twice = bind(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, k: (k > 0) & (F.get(s, k - 1) == x))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(bind(twice, exact))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(bind(hashes, among))


def features(text: Column) -> Column:
    """The counted features of a text, as one struct. Every intermediate value is bound to a
    lambda variable, so it is worked out once wherever the optimizer moves the expression."""

    def counted(body: Column, spaced: Column, words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.replace(spaced, F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(words, lambda w: w.isin(STOP_FORMS))).cast("long").alias("n_stop_words"),
            _repeat_words(words).alias("n_repeat_words"))

    return bind(F.coalesce(text, F.lit("")), lambda body: bind(
        F.filter(F.split(body, "\n", -1), lambda x: F.trim(_spaced(x)) != ""), lambda lines: bind(
            _spaced(body), lambda spaced: bind(
                F.array_remove(F.split(spaced, " ", -1), ""), lambda words: counted(body, spaced, words, lines)))))


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (q["n_repeat_words"] * 100 > q["n_words"] * MAX_REPEAT_PERCENT)


def verdict(q: Column, rules=RULES) -> Column:
    """True where every rule of the table holds; compiled into one expression."""
    out = F.lit(True)
    for feature, per, least, most, from_words in rules:
        ratio = q[feature].cast("double") / F.greatest(q[per], F.lit(1))
        holds = F.lit(True)
        if least is not None:
            holds = holds & (ratio >= least)
        if most is not None:
            holds = holds & (ratio <= most)
        out = out & ((q["n_words"] < from_words) | holds)
    return out


def accepted(text: Column, rules=RULES) -> Column:
    """Whether a text passes the base rules and the table."""
    return bind(features(text), lambda q: ~base_failed(q) & verdict(q, rules))


def quality_report(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every row of ``docs`` (doc_id, text)."""
    out = docs.select("doc_id", features(F.col("text")).alias("q"))
    q = F.col("q")
    return out.select("doc_id", "q.*", base_failed(q).alias("base_failed"), (~base_failed(q) & verdict(q, rules)).alias("kept"))
