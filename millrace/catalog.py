"""All queries of the core with their SQL, in one place."""

from __future__ import annotations

from .plans import chat, joins, nested, records, rollout, sampling, text, training

PLANS = (nested, sampling, chat, training, text, joins, rollout, records)


def queries() -> dict:
    return {k: f for plan in PLANS for k, f in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for plan in PLANS for k, q in plan.ORACLE.items()}
