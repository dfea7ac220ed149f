"""Every registered query; importing the package fills the registry."""

from tabulark.plans import (  # noqa: F401
    aggregation,
    facts,
    lookups,
    modelling,
    preparation,
    scoring,
    text_mining,
    valuation,
)
from tabulark.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
