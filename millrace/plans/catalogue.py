"""Every query of the engine by name, and its SQL twin for DuckDB."""

from . import answers, chats, cleaning, connectors, passages, runs

_PARTS = (cleaning, passages, answers, chats, runs, connectors)
QUERIES = {name: q for part in _PARTS for name, q in part.QUERIES.items()}
SQL = {name: s for part in _PARTS for name, s in part.SQL.items()}
