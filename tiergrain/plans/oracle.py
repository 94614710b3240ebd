"""Independent DuckDB SQL for every dataset (the correctness oracle).

Each dataset is a CTE body plus its dependencies; ``build`` emits a single
``WITH`` statement in dependency order for one final SELECT. Raw tables come
from the shared bindings text, everything after them is written here in SQL
(not derived from the Spark code), also the rules (``oracle_rules``), so the two
engines check each other.

Conventions (SURVEY §7.3): a rule passes only when TRUE (``coalesce(.., false)``);
divisions use ``NULLIF(d, 0)``; ordering ties are broken explicitly with
``NULLS FIRST`` where Spark sorts nulls first; every DOUBLE of a final result
is rounded to the same coarse grid (``stab``) as the Spark wrapper.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from tiergrain.sources.bindings import BINDINGS

CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, body: str, deps: Iterable[str]) -> None:
    CTES[name] = (body, tuple(deps))


def _order(names: Iterable[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen or n in BINDINGS:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def _raw_needed(names: Sequence[str]) -> list[str]:
    raws: list[str] = []

    def visit(n: str) -> None:
        if n in BINDINGS:
            if n not in raws:
                raws.append(n)
            return
        for d in CTES[n][1]:
            visit(d)

    for n in names:
        visit(n)
    return raws


def build(final_sql: str, deps: Sequence[str]) -> str:
    """One statement: raw CTEs, dataset CTEs in order, then ``final_sql``."""
    raws = _raw_needed(deps)
    parts = [BINDINGS[r].duck_cte() for r in raws]
    parts += [f"{n} AS (\n{CTES[n][0]}\n)" for n in _order(deps)]
    return "WITH " + ",\n".join(parts) + "\n" + final_sql


def stab(source: str, doubles: Sequence[str], select: str = "*") -> str:
    """Final SELECT rounding the listed DOUBLE columns to single precision."""
    if not doubles:
        return f"SELECT {select} FROM {source}"
    rep = ", ".join(f"(CASE WHEN abs({c}) < 4194304.0 THEN CAST(CAST({c} AS FLOAT) AS DOUBLE) "
                    f"ELSE round({c} * 8.0) / 8.0 END) + 0.0 AS {c}" for c in doubles)
    return f"SELECT {select} REPLACE ({rep}) FROM {source}"
