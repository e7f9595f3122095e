"""All queries of the library and the SQL that checks them."""

from .plans import curation, relational, streams

_PARTS = (curation, relational, streams)
QUERIES = {k: v for part in _PARTS for k, v in part.QUERIES.items()}
ORACLE_SQL = {k: v for part in _PARTS for k, v in part.ORACLE_SQL.items()}
