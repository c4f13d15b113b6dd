"""Registered queries."""


def all_queries():
    """(queries, oracle SQL) by name."""
    from . import flagship, q_changelog, q_sources, q_streams, q_values  # noqa: F401  registration
    from .registry import ORACLES, QUERIES
    return QUERIES, ORACLES
