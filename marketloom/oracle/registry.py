"""SQL for every registered query that SQL can express."""

from __future__ import annotations

from marketloom.oracle.base import statement
from marketloom.oracle.dashboards import DASHBOARD_SQL, EXTRA_CTES
from marketloom.oracle.declared import DECLARED_SQL
from marketloom.oracle.models import CTES, shown
from marketloom.oracle.operators import OPERATOR_SQL
from marketloom.oracle.quality import QUALITY_SQL
from marketloom.oracle.sources import SOURCE_SQL
from marketloom.plans.warehouse import MODELS


def all_sql() -> dict[str, str]:
    ctes = {**CTES, **EXTRA_CTES}
    finals = {name: shown(name) for name in MODELS}
    finals |= DASHBOARD_SQL
    finals |= OPERATOR_SQL
    finals |= DECLARED_SQL
    finals |= QUALITY_SQL
    finals |= SOURCE_SQL
    return {name: statement(sql, ctes) for name, sql in finals.items()}
