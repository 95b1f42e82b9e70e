from __future__ import annotations


def load_all():
    """Import every query module and return the registry."""
    from tabwright.plans import cleaning, columns, encoders, end_to_end, learning, statistics  # noqa: F401
    from tabwright.plans.registry import REGISTRY

    return REGISTRY
