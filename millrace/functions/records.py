"""Prompts, records and comparisons from the columns of sources, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import normalized_answer, strip



def context_prompt(sentences: Column, question: Column) -> Column:
    """All sentences of nested lists, a line each, and the question."""
    return F.concat(F.array_join(F.flatten(sentences), "\n"), F.lit("\n\nQuestion: "), question)


def instructed_prompt(instructions: Column, text: Column) -> Column:
    return F.concat(F.coalesce(instructions, F.lit("")), F.lit("\n\n"), F.coalesce(text, F.lit("")))


def issue_prompt(repo: Column, problem: Column, hints: Column, command: Column) -> Column:
    """A task on a repository; empty fields get a default, empty hints and commands no block."""
    some = lambda c, default: F.coalesce(F.nullif(strip(c), F.lit("")), F.lit(default))
    block = lambda title, c: F.when(F.coalesce(strip(c), F.lit("")) != "", F.concat(F.lit(f"\n\n{title}:\n"), strip(c))).otherwise("")
    return F.concat(F.lit("Repository: "), F.replace(some(repo, "(unknown)"), F.lit("/"), F.lit("__")), F.lit("\n\n"), some(problem, "(no description)"), block("Hints", hints), block("Test command", command))


def descriptor(name: Column, description: Column, parameters: Column) -> Column:
    """A tool's description as JSON in the envelope that models read; parameters are JSON themselves."""
    return F.to_json(F.struct(F.lit("function").alias("type"), F.struct(name.alias("name"), F.coalesce(description, F.lit("")).alias("description"), F.coalesce(parameters, F.lit('{"type":"object","properties":{}}')).alias("parameters")).alias("function")))


def speaker_messages(turns: Column) -> Column:
    """(from, value) turns as messages: human is the user, all others the assistant."""
    return F.transform(turns, lambda t: F.struct(F.when(t["from"] == "human", "user").otherwise("assistant").alias("role"), t["value"].alias("content")))


def joined_parts(parts: Column, sep: str = "", strict: bool = False) -> Column:
    """The text of (type, text) parts; strictly, null if one of them is no text."""
    text = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: p["text"]), sep)
    return F.when(~F.exists(parts, lambda p: p["type"] != "text"), text) if strict else text


def tool_calls(items: Column, kind: str = "function_call") -> Column:
    """The calls among response items, null if there is none."""
    own = F.filter(items, lambda i: i["type"] == kind)
    return F.when(F.size(own) > 0, own)


def comparison_messages(prompt: Column, a: Column, b: Column, label: Column | None = None) -> Column:
    """A conversation that shows two completions under headings and, for training, which is better."""
    head = lambda x: F.array(F.struct(F.lit("system").alias("role"), F.lit(f"==== Completion {x} ====").alias("content")))
    shown = F.concat(prompt, head("A"), a, head("B"), b, F.array(F.struct(F.lit("system").alias("role"), F.lit("==== Preference ====").alias("content"))))
    return shown if label is None else F.concat(shown, F.array(F.struct(F.lit("assistant").alias("role"), label.alias("content"))))


def differ_at_the_end(a: Column, b: Column) -> Column:
    """Whether two conversations are of one length and differ in the last message only."""
    n = F.size(a)
    return (n == F.size(b)) & (n > 0) & (F.slice(a, 1, n - 1) == F.slice(b, 1, n - 1)) & (F.try_element_at(a, F.lit(-1)) != F.try_element_at(b, F.lit(-1)))


def any_gold(answer: Column, gold: Column) -> Column:
    """Whether the answer equals one of the gold ones in normal form."""
    return F.coalesce(F.exists(gold, lambda g: normalized_answer(g) == normalized_answer(answer)), F.lit(False))


def gold_of(*candidates: Column) -> Column:
    """The first list of gold answers that isn't null or empty."""
    return F.coalesce(*[F.when(F.size(c) > 0, c) for c in candidates])


def optional(df: DataFrame, name: str, default: Column) -> Column:
    """A column of df, or the default where it is missing or null."""
    return F.coalesce(F.col(name), default) if name in df.columns else default


def thought(text: Column) -> tuple[Column, Column]:
    """(reasoning, content) of an answer with a think block; blank content is ''."""
    reasoning = F.nullif(F.regexp_extract(text, r"(?s)<think>(.*?)</think>", 1), F.lit(""))
    return strip(reasoning), strip(F.regexp_replace(text, r"(?s)<think>.*?</think>", ""))


def tagged_call(text: Column) -> Column:
    """(name, args) of the first function_call tag, null if its JSON isn't an object of both."""
    raw = F.nullif(F.regexp_extract(text, r"(?s)<function_call>(.*?)</function_call>", 1), F.lit(""))
    call = F.struct(F.get_json_object(raw, "$.name").alias("name"), F.get_json_object(raw, "$.args").alias("args"))
    return F.when(call["name"].isNotNull() & call["args"].startswith("{"), call)


def error_kind(message: Column) -> Column:
    """permission, context, parse or other."""
    m = F.lower(F.coalesce(message, F.lit("")))
    return F.when(m.rlike("permission|unauthorized|forbidden|denied"), "permission").when(m.rlike("context length|maximum context|max_tokens|too many tokens|too long"), "context").when(m.rlike("parse|json|decode|invalid"), "parse").otherwise("other")


def script_language(text: Column) -> Column:
    """A label by script: rules stand in for a model."""
    return F.when(text.rlike(r"\p{IsGreek}"), "el").when(text.rlike(r"\p{IsCyrillic}"), "ru").when(text.rlike(r"\p{IsHan}"), "zh").when(text.rlike("[äöüß]"), "de").when(text.rlike("[ñ¿¡]"), "es").when(text.rlike("[çêœàè]"), "fr").otherwise("en")


def image_name(repo: Column) -> Column:
    """A name for a container: no slashes or colons, the last twelve characters of it."""
    return F.right(F.translate(repo, "/:", "__"), F.lit(12))


def replaced(text: Column, old: str, new: str) -> tuple[Column, Column]:
    """(text, count): every occurrence replaced, and how many there were."""
    count = (F.length(text) - F.length(F.replace(text, F.lit(old), F.lit("")))) / len(old)
    return F.replace(text, F.lit(old), F.lit(new)), count.cast("int")


def viewed(text: Column, start: int, stop: int) -> Column:
    """Lines start to stop, counted from 1."""
    return F.array_join(F.slice(F.split(text, "\n"), start, max(0, stop - start + 1)), "\n")


def inserted(text: Column, at: int, line: str) -> Column:
    """A line put after line `at`, which is clamped to the text."""
    lines = F.split(text, "\n")
    return F.array_join(F.concat(F.slice(lines, 1, F.least(F.lit(at), F.size(lines))), F.array(F.lit(line)), F.slice(lines, F.least(F.lit(at), F.size(lines)) + 1, F.size(lines))), "\n")
