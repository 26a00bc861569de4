"""Graders that need more than regular expressions: braces, nested tuples, normal forms of numbers. Plain Python, and Arrow UDFs of it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType


def boxed(text: str | None) -> str | None:
    r"""What the \boxed{} that is closed last holds; else the word after \boxed; null if braces don't match."""
    if not text:
        return None
    found, opened, at = None, [], 0
    while at < len(text):
        if text.startswith("\\boxed{", at):
            opened.append((at + 7, True))
            at += 7
            continue
        if text[at] == "{":
            opened.append((at + 1, False))
        elif text[at] == "}":
            if not opened:
                return None
            start, is_box = opened.pop()
            if is_box:
                found = text[start:at]
        at += 1
    if found is None and (m := re.search(r"\\boxed\s+([A-Za-z0-9]+)", text)):
        found = m[1]
    return found


def number_form(text: str | None) -> str | None:
    """A normal form of an answer: no units, spaces, thousands marks or dollar signs, plain fractions, no trailing zeros."""
    if text is None:
        return None
    x = re.sub(r"\\(?:left|right|,|!|;|\s)", "", text.strip())
    x = re.sub(r"\\(?:text|mbox|mathrm)\{[^{}]*\}", "", x)
    x = re.sub(r"\\d?t?frac\s*\{([^{}]*)\}\s*\{([^{}]*)\}", r"(\1)/(\2)", x)
    x = re.sub(r"\\d?t?frac\s*(\d)\s*(\d)", r"(\1)/(\2)", x)
    x = re.sub(r"\\sqrt\s*\{?(\w+)\}?", r"sqrt(\1)", x)
    x = re.sub(r"[\s$%\\]|\^\{?\\?circ\}?", "", x).rstrip(".")
    x = re.sub(r"(?<=\d),(?=\d{3}(?:\D|$))", "", x)
    x = re.sub(r"\((-?\w+)\)/\((-?\w+)\)", r"\1/\2", x)
    if re.fullmatch(r"[-+]?\d*\.\d+", x):
        x = x.rstrip("0").rstrip(".") or "0"
        x = x.replace("-.", "-0.") if x.startswith("-.") else "0" + x if x.startswith(".") else x
    return x.lower()


def parts_of(text: str) -> list[str]:
    """The elements of a tuple or interval; anything else is its own."""
    x = text.strip()
    if len(x) > 2 and x[0] in "([" and x[-1] in ")]" and not any(c in x[1:-1] for c in "()[]"):
        return [p.strip() for p in x[1:-1].split(",")]
    return [x]


def same_answer(given: str | None, truth: str | None) -> bool:
    """Whether two answers are equal in normal form, element by element for tuples; brackets must be alike."""
    if given is None or truth is None:
        return False
    a, b = number_form(given), number_form(truth)
    if a == b:
        return True
    x, y = parts_of(given), parts_of(truth)
    if len(x) != len(y) or len(x) == 1:
        return False
    return given.strip()[0] == truth.strip()[0] and given.strip()[-1] == truth.strip()[-1] and all(number_form(p) == number_form(q) for p, q in zip(x, y))


@F.pandas_udf(StringType())
def boxed_udf(x: pd.Series) -> pd.Series:
    return x.map(boxed)


@F.pandas_udf(StringType())
def number_form_udf(x: pd.Series) -> pd.Series:
    return x.map(number_form)


@F.pandas_udf(BooleanType())
def same_answer_udf(x: pd.Series, y: pd.Series) -> pd.Series:
    return pd.Series([same_answer(a, b) for a, b in zip(x, y)])
