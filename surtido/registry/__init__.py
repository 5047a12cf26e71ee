"""Queries over the given tables, each with its SQL twin where SQL can express it."""

from surtido.registry import catalog, lines, model, series, serving, tables

MODULES = (lines, catalog, serving, series, model, tables)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
