"""Queries of problem 5: nested records as flat tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested
from ..operators.deliveries import latest_delivery
from ..session import table

#: Table, record id, nested column, declared tools.
INPUTS = (("tool_runs", "run_id", "trajectory", "tools"), ("chats", "chat_id", "messages", None))


def emitted(spark: SparkSession, sf_dir: str, payload: bool) -> list[tuple[str, DataFrame]]:
    return [(name, nested.emit(latest_delivery(table(spark, sf_dir, name), rec), rec, col, tools, payload)) for name, rec, col, tools in INPUTS]


def together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = emitted(spark, sf_dir, payload=False)
    return together([nested.links(x).select(F.lit(tab).alias("tab"), "rec_id", "link", "parent_key", "child_key") for tab, x in parts])


def flat(tag: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return together([nested.flat_table(x, tag).select(F.lit(tab).alias("tab"), "*") for tab, x in emitted(spark, sf_dir, payload=True)])

    return query


QUERIES = {"p5_found": p5_found} | {f"p5_{tag}": flat(tag) for tag in nested.PAYLOADS}
#: SQL for the parts that SQL can say: messages and calls with their keys. The rest is tested against a brute force.
_LAST = "(SELECT * FROM {t} WHERE {k} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY ingested_at DESC NULLS LAST) = 1)"
_BOTH = " UNION ALL ".join(
    "SELECT '{t}' AS tab, {k} AS rec_id, unnest(range(len({m}))) AS i, unnest({m}) AS m FROM ".format(t=t, k=k, m=m) + _LAST.format(t=t, k=k) for t, k, m, _ in INPUTS
)
ORACLE = {
    "p5_messages": f"SELECT tab, rec_id, 'm' || i AS pk, NULL::VARCHAR AS parent_key, m.role AS role, m.content AS content, m.reasoning AS reasoning, m.name AS name, m.tool_call_id AS tool_call_id FROM ({_BOTH})",
    "p5_calls": f"SELECT tab, rec_id, 'm' || i || '.c' || j AS pk, 'm' || i AS parent_key, c.id AS id, c.type AS type, c.function.name AS name, c.function.arguments AS arguments FROM (SELECT tab, rec_id, i, unnest(range(len(m.tool_calls))) AS j, unnest(m.tool_calls) AS c FROM ({_BOTH}))",
}
