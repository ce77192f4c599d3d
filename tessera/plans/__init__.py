"""Named queries over the driver tables, each with its DuckDB oracle when SQL can say it."""

from tessera.plans.registry import ORACLE_SQL, QUERIES, register
from tessera.plans import bundles as _bundles  # noqa: F401  (registers queries)
from tessera.plans import schedule as _schedule  # noqa: F401
from tessera.plans import web as _web  # noqa: F401
from tessera.plans import text as _text  # noqa: F401
from tessera.plans import graph as _graph  # noqa: F401
from tessera.plans import contacts as _contacts  # noqa: F401
from tessera.plans import stats as _stats  # noqa: F401

__all__ = ["QUERIES", "ORACLE_SQL", "register"]
