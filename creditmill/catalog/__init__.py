"""Registered queries over the star schema and the SQL each must agree with."""

from creditmill.catalog import analysis, ingest, learned, prepared, scored

PARTS = (ingest, analysis, prepared, scored, learned)
QUERIES = {name: q for part in PARTS for name, q in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
