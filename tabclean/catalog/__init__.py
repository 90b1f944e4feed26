"""Queries over the given tables, one or more per operator."""


def load():
    """All registered queries and oracle texts."""
    from . import q_aggregate, q_clean, q_filter, q_profile, q_source  # noqa: F401
    from .registry import ORACLES, QUERIES

    return dict(QUERIES), dict(ORACLES)
