"""Scalar functions on answers, transcripts, names and JSON, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII punctuation.
PUNCTUATION = r"[!-/:-@\[-`{-~]"


def strip(x: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def normalized_answer(x: Column) -> Column:
    """Lower case, no punctuation, no articles, single blanks."""
    x = F.regexp_replace(F.lower(x), PUNCTUATION, "")
    x = F.regexp_replace(x, r"\b(a|an|the)\b", " ")
    return strip(F.regexp_replace(x, r"\s+", " "))


def marked_answer(x: Column, mark: str = "Answer:") -> Column:
    """What follows the mark if it occurs exactly once, else null."""
    parts = F.split(x, mark, -1)
    return F.when(F.size(parts) == 2, strip(F.try_element_at(parts, F.lit(2))))


def hash_answer(x: Column) -> Column:
    """The rest of the last line that starts with ####, without leading colon and without commas; else null."""
    lines = F.filter(F.transform(F.split(x, "\n"), strip), lambda y: y.startswith("####"))
    last = F.try_element_at(lines, F.lit(-1))
    return strip(F.replace(F.regexp_replace(strip(F.substring(last, F.lit(5), F.length(last))), "^:", ""), F.lit(","), F.lit("")))


def tool_name(x: Column) -> Column:
    """Letters, digits and underscores; none at the ends; `tool_` before a digit; null if nothing is left."""
    y = F.regexp_replace(F.regexp_replace(x, "[^0-9A-Za-z]", "_"), "^_+|_+$", "")
    return F.nullif(F.when(y.rlike("^[0-9]"), F.concat(F.lit("tool_"), y)).otherwise(y), F.lit(""))


def transcript(x: Column) -> Column:
    """Turns (role, content) of a text of Human: and Assistant: turns."""
    speakers = F.regexp_extract_all(x, F.lit("(Human:|Assistant:)((?:(?!Human:|Assistant:)[\\s\\S])*)"), 1)
    said = F.regexp_extract_all(x, F.lit("(Human:|Assistant:)((?:(?!Human:|Assistant:)[\\s\\S])*)"), 2)
    role = lambda s: F.when(s == "Human:", F.lit("user")).otherwise(F.lit("assistant"))
    return F.zip_with(speakers, said, lambda s, t: F.struct(role(s).alias("role"), strip(t).alias("content")))


def feedback(guess: Column, secret: Column) -> Column:
    """Answer to `Guess: n`: correct, too high, too low, or how to guess."""
    n = F.regexp_extract(guess, r"(?m)^Guess: (\d{1,9})\s*$", 1)
    value = n.try_cast("int")
    return F.when(value.isNull(), "Please write Guess: and a number.").when(value == secret, "Correct").when(value > secret, "Too high").otherwise("Too low")


def format_reward(correct: Column, formatted: Column, coef: float = 0.1) -> Column:
    """correct + coef (format - 1)."""
    return correct.cast("double") + coef * (formatted.cast("double") - 1)


def is_int(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^\s*-?\d{1,3}(,\d{3})*\s*$|^\s*-?\d+\s*$"), F.lit(False))


def is_float(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"), F.lit(False))


def is_fraction(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^-?\d+/0*[1-9]\d*$"), F.lit(False))


def shortened(x: Column, most: int = 256) -> Column:
    """A long text as its two ends."""
    half = most // 2
    return F.when(F.length(x) > most, F.concat(F.left(x, F.lit(half)), F.lit(" ... "), F.right(x, F.lit(half)))).otherwise(x)


def html_text(x: Column, words: int = 10_000) -> Column:
    """The text of a page: without scripts, styles, comments and tags, entities of marks resolved, single blanks, the first words of it (a feature: what a reader is shown)."""
    y = F.regexp_replace(x, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)>|<!--.*?-->", " ")
    y = F.regexp_replace(y, r"<[^>]+>", " ")
    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        y = F.replace(y, F.lit(entity), F.lit(mark))
    return F.array_join(F.slice(F.filter(F.split(y, r"\s+"), lambda w: w != ""), 1, words), " ")


def valid_json(x: Column) -> Column:
    return F.try_parse_json(x).isNotNull()


def questions(x: Column) -> Column:
    """What stands between question tags, trimmed, without empty ones."""
    return F.filter(F.transform(F.regexp_extract_all(x, F.lit("(?is)<question>(.*?)</question>"), 1), strip), lambda q: q != "")


def split_at_stop(x: Column, stop: str) -> tuple[Column, Column]:
    """(text, ended): the text before the stop sequence; ended if there is exactly one, null text if there are more."""
    parts = F.split(x, stop, -1)
    return F.when(F.size(parts) <= 2, strip(F.get(parts, 0))), F.size(parts) == 2
