"""The operators as queries over the given tables, each with its SQL equivalent."""

from tidemark.catalog import files, tables

QUERIES = {**tables.QUERIES, **files.QUERIES}
SQL = {**tables.SQL, **files.SQL}
