"""How a text ends: complete by its last mark, certainly cut, or open, to be judged by what usually follows its last words."""

from __future__ import annotations

import json
import re

from .residue_rules import ERROR, FIELD, told

# Abbreviations that a sentence goes on after.
ABBREVIATIONS = frozenset(
    "approx. cf. no. e.g. i.e. vs. dr. mr. mrs. ms. prof. fig. eq. ca. z.b. bzw. d.h. nr. vgl. inkl. env. p.ex. c.-à-d. n° av. aprox. p.ej. núm. pág. sr. sra. art.".split()
)
# Words for nothing and labels that an empty answer may consist of.
NOTHING = frozenset("n/a na none null nil nan undefined empty response answer antwort réponse respuesta output result content [no content] [empty] <answer></answer> tbd todo".split()) | {"no content", "no answer", "no response"}
#: What follows the closing mark of a complete text.
AFTER = re.compile(r"(?:\s*(?:\[\d+\]|\[\^\d+\]|[✔✓☑🙂😀🙏👍]|[\"”“»)\]*_’'>}]))+$")
#: The characters that AFTER can end with.
CLOSERS = frozenset("✔✓☑🙂😀🙏👍\"”“»)*_’'>}]")
#: Texts that trail off on purpose.
TRAILING = re.compile(r"(?:only the beginning|and so on|and so forth|to be continued|who knows|we will see|und so weiter|usw|wer weiß|fortsetzung folgt|et ainsi de suite|etc|à suivre|qui sait|y así sucesivamente|y así|continuará|quién sabe|nur der anfang|que le début|solo el (?:comienzo|principio))\W*$", re.I)
ITEM = re.compile(r"\s*(?:[-*•+]|\d+[.)])(?:\s|$)")
SUM = re.compile(r"(\d+) \+ (\d+) = (\d+)$")
JSON_START = re.compile(r"\s*[\[{]\s*(?:[\"{\[\]}\d-]|true|false|null)")
_NAME, _DIGITS, _SPLIT = re.compile(r"\b[^\W\d_a-zà-ÿ]\w*"), re.compile(r"\d+(?:[.,]\d+)*"), re.compile(r"[\s/]+")


def shape(line: str) -> str:
    """The line with names and numbers alike."""
    return _DIGITS.sub("9", _NAME.sub("N", line))


def judge(role: str | None, text: str | None) -> tuple[str, str]:
    """(verdict, last line): complete, cut, item (open, a list item) or line (open, another line)."""
    s = (text or "").rstrip(" \t\r\n\v\f ​﻿")
    if not s.strip() or not any(c.isalnum() for c in s):
        return "complete", ""
    if JSON_START.match(s) and (role == "tool" or s[0] == "{" or s[:2] in ('["', "[{")) and not FIELD.match(s):
        try:
            json.loads(s)
            return "complete", ""
        except RecursionError:
            return "complete", ""
        except ValueError:
            return ("cut", "") if s.count("{") + s.count("[") > s.count("}") + s.count("]") or s.count('"') % 2 else ("complete", "")
    if s.count("```") % 2:
        return ("cut", "") if len(s.strip("`\n ")) else ("complete", "")
    last = s[s.rfind("\n") + 1 :]
    dots = s.endswith(("…", "..."))
    if dots:
        return ("complete" if TRAILING.search(s) else "cut"), ""
    bare = AFTER.sub("", s) if s[-1] in CLOSERS else s
    if not bare or bare.endswith("```"):
        return "complete", ""
    if bare.endswith("|") and last.lstrip().startswith("|"):
        above = s[: len(s) - len(last)].rstrip("\n").rsplit("\n", 1)[-1].strip()
        return ("cut" if above.startswith("|") and last.count("|") < above.count("|") else "complete"), ""
    end = bare[-1]
    if end in ".!?。؟:;":
        word = bare.rsplit(None, 1)[-1].lower().lstrip("(\"'“„«")
        if end == "." and len(s.split()) > 2 and (word in ABBREVIATIONS or (ITEM.fullmatch(last) is not None)):
            return "cut", ""
        if end not in ":;":
            return "complete", ""
    if FIELD.search(last) or told(last) or ERROR.fullmatch(last) or last.endswith(">") and last.lstrip().startswith("<"):
        return "complete", ""
    if end == ")" or (bare != s and s[-1] == ")" and last.rfind("(") > 0):
        return "complete", ""
    if s.strip(" :.").lower() in NOTHING:
        return "complete", ""
    if "\n" not in s and s[:1].islower() and role == "user":
        return "complete", ""  # a casual turn
    if "\n" not in s and len(s.split()) <= 3 and end not in ",:;":
        return "complete", ""  # a name, a number, a word or two
    if last.lstrip().startswith("|"):
        return "cut", ""
    if last.count("{") > last.count("}") or last.count("(") > last.count(")") and not ITEM.match(last):
        return "cut", ""
    if (m := SUM.search(last)) and (total := str(int(m[1]) + int(m[2]))) != m[3] and total.startswith(m[3]):
        return "cut", ""
    open_ = bare[bare.rfind("\n") + 1 :]
    if ITEM.match(last) is not None:
        return ("item", open_) if ITEM.fullmatch(last) is None else ("cut", "")
    return "line", open_


def parts(line: str) -> list[str]:
    return [p for p in _SPLIT.split(shape(line).strip()) if p]


def word_of(line: str) -> str:
    """The last word of a list item, numbers alike."""
    return _DIGITS.sub("9", line.split()[-1])


def tail(word: str) -> str | None:
    """The last letters of what may be a name."""
    return "^" + word[-3:] if word[:1].isupper() and word.isalpha() and len(word) > 3 else None


def items_of(text: str) -> list[list[str]]:
    """The words of the list items of a text that other lines follow."""
    return [AFTER.sub("", x).split() for x in text.split("\n")[:-1] if ITEM.match(x)]
