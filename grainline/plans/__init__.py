"""End-to-end jobs and the registered queries."""

from grainline.plans import (  # noqa: F401
    queries_cleaning,
    queries_keys,
    queries_profile,
    queries_rules,
    queries_sources,
    queries_supply,
)
from grainline.plans.registry import CHECKS, QUERIES  # noqa: F401
