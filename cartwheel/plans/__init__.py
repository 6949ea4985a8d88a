"""The models and the jobs built on them."""

from __future__ import annotations


def load_models() -> None:
    """Import every model module so that each registers itself."""
    from cartwheel.plans import (  # noqa: F401
        core, customers, intermediate, operations, products, revenue, semantic, staging, web,
    )
