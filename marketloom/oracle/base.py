"""Helpers that write DuckDB SQL text.

Averages and ratios are rounded half-up on integers, so that both engines give
the same digits; money is DECIMAL until the outermost SELECT."""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"


def rat(num: str, den: str, digits: int, mult: int = 1) -> str:
    """``num * mult / den`` for integer expressions, as DECIMAL(37, digits)."""
    n = f"(CAST({num} AS HUGEINT)*{mult * 10**digits})"
    d = f"CAST({den} AS HUGEINT)"
    i = (
        f"(CASE WHEN {d}=0 THEN NULL WHEN {n}>=0 THEN (2*{n}+{d})//(2*{d})"
        f" ELSE -((2*(-{n})+{d})//(2*{d})) END)"
    )
    unit = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    return f"(CAST({i} AS DECIMAL(30,0))*CAST({unit} AS DECIMAL({digits + 1},{digits})))"


def whole(x: str, scale: int) -> str:
    return f"CAST(({x})*{10**scale} AS HUGEINT)" if scale else f"CAST({x} AS HUGEINT)"


def avg(x: str, scale: int = 2, digits: int = 6) -> str:
    return rat(f"SUM({whole(x, scale)})", f"COUNT({x})*{10**scale}", digits)


def ravg(x: str, digits: int = 2, scale: int = 6) -> str:
    """``round(avg(x), digits)`` as DOUBLE."""
    return dbl(avg(x, scale, digits))


def wavg(w: str, x: str, digits: int = 6, unit: int = 1) -> str:
    n = f"SUM(CAST(({w})*CAST(({x}) AS HUGEINT) AS HUGEINT))"
    return rat(n, f"SUM(CASE WHEN ({x}) IS NOT NULL THEN {w} END)*{unit}", digits)


def div(num: str, den: str, digits: int = 2, scale: int = 2) -> str:
    return rat(whole(num, scale), f"({den})*{10**scale}", digits)


def pct(num: str, den: str, scale: int = 0, digits: int = 2, den_scale: int | None = None) -> str:
    ds = 0 if den_scale is None else den_scale
    return rat(f"{whole(num, scale)}*{10**ds}", f"{whole(den, ds)}*{10**scale}", digits, 100)


def isum(x: str) -> str:
    return f"CAST(SUM({x}) AS BIGINT)"


def msum(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(18,2))"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def flag(cond: str) -> str:
    return f"COALESCE({cond}, FALSE)"


def count_if(cond: str) -> str:
    return f"COUNT(CASE WHEN {cond} THEN 1 END)"


def ladder(x: str, steps, otherwise: str, null: str | None = None) -> str:
    body = " ".join(f"WHEN {x} >= {b} THEN '{label}'" for b, label in steps)
    if null:
        body += f" WHEN {x} IS NULL THEN '{null}'"
    return f"CASE {body} ELSE '{otherwise}' END"


def month(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS TIMESTAMP)"


def days(later: str, earlier: str) -> str:
    return f"date_part('day', {later} - {earlier})"


def statement(final: str, ctes: dict[str, str]) -> str:
    """``final`` preceded by the CTEs it needs, in dependency order."""
    need: list[str] = []

    def visit(sql: str) -> None:
        for name in ctes:
            if name not in need and re.search(rf"\b{name}\b", sql):
                visit(ctes[name])
                if name not in need:
                    need.append(name)

    visit(final)
    if not need:
        return final
    body = ",\n".join(f"{n} AS ({ctes[n]})" for n in need)
    return f"WITH {body}\n{final}"
