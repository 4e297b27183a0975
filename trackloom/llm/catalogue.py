"""The queries of this subpackage and their SQL, where SQL can express them."""

from trackloom.llm import queries

QUERIES = dict(queries.QUERIES)
SQL = dict(queries.SQL)
