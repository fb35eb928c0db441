"""Registered queries (``catalog``, ``streams``) and their SQL oracles (``oracle``)."""

from . import catalog, oracle, streams  # noqa: F401  (importing registers the queries)

REGISTRY = catalog.REGISTRY
ORACLE = oracle.ORACLE
