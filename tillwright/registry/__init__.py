"""All registered queries and their SQL twins."""

from tillwright.registry import clicks, forecasts, retail, series

_PARTS = [retail.registry, series.registry, forecasts.registry, clicks.registry]

QUERIES = {name: query for part in _PARTS for name, query in part.queries.items()}
ORACLES = {name: sql for part in _PARTS for name, sql in part.oracles.items()}
