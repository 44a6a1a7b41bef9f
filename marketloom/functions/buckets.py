"""CASE ladders, range buckets and the state lookup."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _num(v) -> Column:
    return F.lit(Decimal(v)) if isinstance(v, str) else F.lit(v)


def ladder(c: Column | str, steps: list[tuple], otherwise, null=None) -> Column:
    """First step whose threshold the value reaches; NULL falls through to
    ``otherwise`` (or to ``null`` where the model names a label for it)."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for bound, label in steps:
        cond = c >= _num(bound)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    if null is not None:
        out = out.when(c.isNull(), null)
    return out.otherwise(otherwise)


def ranges(c: Column | str, steps: list[tuple], otherwise: str) -> Column:
    """Closed ranges ``(low, high, label)``; ``low=None`` means ``< high`` and
    ``high=None`` means ``>= low``.  Gaps fall to ``otherwise``."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for low, high, label in steps:
        if low is None:
            cond = c < _num(high)
        elif high is None:
            cond = c >= _num(low)
        else:
            cond = c.between(_num(low), _num(high))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(otherwise)


# Names of the 27 Brazilian federative units by code.
BRAZIL_STATES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AP": "Amapá",
    "AM": "Amazonas",
    "BA": "Bahia",
    "CE": "Ceará",
    "DF": "Distrito Federal",
    "ES": "Espírito Santo",
    "GO": "Goiás",
    "MA": "Maranhão",
    "MT": "Mato Grosso",
    "MS": "Mato Grosso do Sul",
    "MG": "Minas Gerais",
    "PA": "Pará",
    "PB": "Paraíba",
    "PR": "Paraná",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RS": "Rio Grande do Sul",
    "RO": "Rondônia",
    "RR": "Roraima",
    "SC": "Santa Catarina",
    "SP": "São Paulo",
    "SE": "Sergipe",
    "TO": "Tocantins",
}


def state_name(code: Column | str) -> Column:
    """Full state name; an unknown code is returned unchanged."""
    code = F.col(code) if isinstance(code, str) else code
    table = F.create_map(*[F.lit(x) for kv in BRAZIL_STATES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, code), code)
