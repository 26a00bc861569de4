"""All queries of the text operators with their SQL."""

from __future__ import annotations

from . import queries_cuts, queries_defects, queries_leaks, queries_packing, queries_residue, queries_similar, queries_spans

PLANS = (queries_cuts, queries_similar, queries_defects, queries_residue, queries_packing, queries_leaks, queries_spans)


def queries() -> dict:
    return {k: f for plan in PLANS for k, f in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for plan in PLANS for k, q in plan.ORACLE.items()}
