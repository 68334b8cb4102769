"""Names of the registered queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from framelake.llm import queries, sql

QUERIES = {name: f for name, f in vars(queries).items() if name.startswith("op")}
ORACLES = dict(sql.ORACLES)
