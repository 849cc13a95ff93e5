"""The registered queries: every operator over the driver tables, with the SQL it must agree with."""

from foldloom.queries import checking, cleaning, files, folding

_ALL = {**cleaning.QUERIES, **folding.QUERIES, **checking.QUERIES, **files.QUERIES}

QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql}
