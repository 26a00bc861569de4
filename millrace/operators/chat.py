"""Conversations as arrays of messages: construction, rendering, selection and filters, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGE = "struct<role:string,content:string>"
#: A tool message is cut to CAP characters; the newest count first, and beyond TOTAL characters nothing older is touched.
CAP, TOTAL = 40_000, 60_000
#: Failed authorisation in a tool's answer.
DENIED = ("unauthorized", "forbidden", "401", "403")


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def history(prompt: Column, system: Column | None = None) -> Column:
    """[system] user; an empty or null system prompt is left out."""
    user = F.array(message("user", prompt))
    if system is None:
        return user
    return F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.array(message("system", system)), user)).otherwise(user)


def single_turn(prompt: Column, content: Column, system: Column | None = None) -> Column:
    """The trajectory of one exchange."""
    return F.concat(history(prompt, system), F.array(message("assistant", F.coalesce(content, F.lit("")))))


def serialized(messages: Column) -> Column:
    """`role: content` lines, as a simulated user reads them."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), F.coalesce(m["content"], F.lit("")))), "\n")


def _joined(messages: Column, one) -> Column:
    return F.array_join(F.transform(messages, one), "")


def role_colon(messages: Column) -> Column:
    """`Role: content` paragraphs and the opening of the next answer."""
    return F.concat(_joined(messages, lambda m: F.concat(F.initcap(m["role"]), F.lit(": "), F.coalesce(m["content"], F.lit("")), F.lit("\n\n"))), F.lit("Assistant:"))


def header_tags(messages: Column) -> Column:
    """Messages between header and end-of-turn tags, after a beginning-of-text tag, and the opening of the next answer."""
    head = lambda role: F.concat(F.lit("<|start_header_id|>"), role, F.lit("<|end_header_id|>\n\n"))
    each = _joined(messages, lambda m: F.concat(head(m["role"]), F.coalesce(m["content"], F.lit("")), F.lit("<|eot_id|>")))
    return F.concat(F.lit("<|begin_of_text|>"), each, head(F.lit("assistant")))


def im_tags(messages: Column) -> Column:
    """Messages between im tags, a line each; answers without thoughts open with a thought tag, as does the next answer."""

    def one(m: Column) -> Column:
        text = F.coalesce(m["content"], F.lit(""))
        think = F.when((m["role"] == "assistant") & ~text.contains("<think>"), F.lit("<think>\n")).otherwise(F.lit(""))
        return F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), think, text, F.lit("<|im_end|>"))

    return F.concat(F.array_join(F.transform(messages, one), "\n"), F.lit("\n<|im_start|>assistant\n<think>\n"))


def last_content(messages: Column, role: str) -> Column:
    """The content of the role's last message that has one, else ''."""
    own = F.filter(messages, lambda m: (m["role"] == role) & m["content"].isNotNull())
    return F.coalesce(F.try_element_at(own, F.lit(-1))["content"], F.lit(""))


def has_tool_turn(messages: Column) -> Column:
    return F.exists(messages, lambda m: m["role"] == "tool")


def calls_tool(messages: Column) -> Column:
    return F.exists(messages, lambda m: (m["role"] == "assistant") & (F.coalesce(F.size(m["tool_calls"]), F.lit(0)) > 0))


def failed(content: Column) -> Column:
    """Whether a tool's answer is a JSON object with a truthy error, or speaks of failed authorisation."""
    error = F.get_json_object(content, "$.error")
    truthy = F.coalesce(error, F.lit("")).isin("", "0", "0.0", "false", "[]", "{}", "null", "-0", "-0.0")
    low = F.lower(F.coalesce(content, F.lit("")))
    denied = F.lit(False)
    for word in DENIED:
        denied = denied | low.contains(word)
    return ~truthy | denied


def sound_tool_use(messages: Column) -> Column:
    """At least one call and no failed answer."""
    return calls_tool(messages) & ~F.exists(messages, lambda m: (m["role"] == "tool") & failed(m["content"]))


def code_block(text: Column, language: str = "python") -> Column:
    """The last closed block of a language, or null; the case of the language doesn't matter."""
    after = F.element_at(F.split(text, f"(?i)```{language}"), -1)
    closed = F.lower(text).contains(f"```{language}") & after.contains("```")
    inner = F.substring_index(after, "```", 1)
    return F.when(closed, F.regexp_replace(F.regexp_replace(inner, r"^[\r\n]+", ""), r"\s+$", ""))


def remapped(messages: Column, roles: dict[str, str]) -> Column:
    """Messages from another viewpoint; roles that aren't in the map stay."""
    table = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv])
    return F.transform(messages, lambda m: F.struct(F.coalesce(table[m["role"]], m["role"]).alias("role"), m["content"].alias("content")))


def response_items(messages: Column) -> Column:
    """Flat items: an answer of a tool, a message, and one item for each of its calls."""
    kind = "struct<type:string,role:string,content:string,call_id:string,name:string>"

    def one(m: Column) -> Column:
        text = F.coalesce(m["content"], F.lit(""))
        item = lambda t, role=None, content=None, call=None, name=None: F.struct(F.lit(t).alias("type"), (role if role is not None else F.lit(None).cast("string")).alias("role"), (content if content is not None else F.lit(None).cast("string")).alias("content"), (call if call is not None else F.lit(None).cast("string")).alias("call_id"), (name if name is not None else F.lit(None).cast("string")).alias("name"))
        calls = F.transform(F.coalesce(m["tool_calls"], F.array().cast("array<struct<id:string,type:string,function:struct<name:string,arguments:string>>>")), lambda c: item("function_call", None, c["function"]["arguments"], c["id"], c["function"]["name"]))
        return F.when(m["role"] == "tool", F.array(item("function_call_output", None, text, m["tool_call_id"]))).otherwise(F.concat(F.array(item("message", m["role"], text)), calls))

    return F.flatten(F.transform(messages, one)).cast(f"array<{kind}>")


def capped(messages: Column, cap: int = CAP, total: int = TOTAL) -> Column:
    """Tool contents cut to `cap`, newest first, until they sum to more than `total`; from there on older ones stay whole."""
    size = lambda m: F.when(m["role"] == "tool", F.least(F.length(F.coalesce(m["content"], F.lit(""))), F.lit(cap))).otherwise(F.lit(0)).cast("bigint")
    newer = lambda i: F.aggregate(F.slice(messages, i + 2, F.size(messages)), F.lit(0).cast("bigint"), lambda a, m: a + size(m))
    return F.transform(messages, lambda m, i: F.struct(m["role"].alias("role"), F.when((m["role"] == "tool") & (newer(i) <= total), F.substring(m["content"], 1, cap)).otherwise(m["content"]).alias("content")))
