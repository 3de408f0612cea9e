"""All checked queries and oracles, by name."""

from __future__ import annotations

from forecourt.checks import changes, daily, functions, gates, landing, models, operators, staging

_MODULES = (models, staging, landing, operators, functions, gates, changes, daily)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
