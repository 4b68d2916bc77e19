"""Text risk measures as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rules import first_match, reasons


def share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part, whole), 4)


def without(text: Column, characters: str) -> Column:
    """Length of the text less these characters."""
    return F.length(F.translate(text, characters, ""))


def repeated_share(parts: Column) -> Column:
    """Share of the parts that equal an earlier one."""
    return share(F.size(parts) - F.size(F.array_distinct(parts)), F.size(parts))


def lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")


def sentences(text: Column) -> Column:
    """Sentences with their end marks, trimmed; blanks drop out."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])\s+"), F.trim), lambda x: x != "")


def quality_codes(rows: DataFrame, text: str, refusals: Sequence[str] = ("i cannot", "as an ai"), shortest: int = 40) -> DataFrame:
    """rows with codes, the ordered reject codes of an answer: refusal, length, garbling, long runs, repetition.

    Lines and sentences are split once, into columns of their own.
    """
    t = F.col(text)
    df = rows.withColumns({"__lines": lines(t), "__sentences": sentences(t)})
    df = df.withColumns({"__same_lines": repeated_share(F.col("__lines")), "__same_sentences": repeated_share(F.col("__sentences"))})
    low = F.lower(t)
    refused = F.lit(False)
    for r in refusals:
        refused = refused | F.contains(low, F.lit(r))
    symbols = F.length(t) - without(t, "#*$%&|<>")
    codes = reasons(
        [
            (refused, "refusal"),
            (F.length(t) < shortest, "too_short"),
            (symbols > 0.1 * F.length(t), "garbled"),
            (t.rlike(r"(.)\1{19}"), "long_run"),
            ((F.size("__lines") >= 4) & (F.col("__same_lines") > 0.6), "repeated_lines"),
            ((F.size("__sentences") >= 3) & (F.col("__same_sentences") > 0.6), "repeated_sentences"),
        ]
    )
    return df.withColumn("codes", codes).drop("__lines", "__sentences", "__same_lines", "__same_sentences")


def complexity(text: Column) -> dict[str, Column]:
    return {
        "n_sentences": F.regexp_count(text, F.lit(r"[.!?]+")).cast("long"),
        "n_numbers": F.regexp_count(text, F.lit(r"[0-9]+")).cast("long"),
        "n_lines": F.size(lines(text)).cast("long"),
        "n_terms": F.size(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("([a-z]{4,})"), F.lit(1)))).cast("long"),
    }


def focus_terms(text: Column, grams: Sequence[int] = (4, 3, 2), longest: int = 8) -> Column:
    """Distinct tokens of two or more letters or digits, and the n-grams of short ones, in order of appearance."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]{2,})"), F.lit(1)))
    short = F.filter(tokens, lambda t: F.length(t).between(4, longest))

    def pieces(n: int) -> Column:
        return F.flatten(F.transform(short, lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substring(t, i, F.lit(n)))))

    return F.array_distinct(F.concat(tokens, *[pieces(n) for n in grams]))


def parsed_number(text: Column) -> Column:
    """The first signed decimal, rounded half to even; null if there is none or it does not fit."""
    x = F.rint(F.nullif(F.regexp_extract(text, r"(-?[0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double"))
    return F.when(F.abs(x) < 9e18, x.cast("long"))


def unique_rubric(rows: DataFrame, key: str, title: str, order: str) -> DataFrame:
    """Rows with white space in titles collapsed, the first of equal titles per key."""
    clean = F.trim(F.regexp_replace(F.col(title), r"[ \t\n\r]+", " "))
    return rows.withColumn(title, clean).groupBy(key, title).agg(F.min(order).alias(order))


def json_candidate(text: Column) -> Column:
    """The outermost braces of a text, without trailing commas."""
    return F.regexp_replace(F.regexp_extract(text, r"(?s)(\{.*\})", 1), r",\s*([}\]])", "$1")


def normalised_level(value: Column, levels: Sequence[str] = ("low", "medium", "high"), default: str = "medium") -> Column:
    low = F.lower(F.trim(value))
    return F.when(low.isin(*levels), low).otherwise(default)
