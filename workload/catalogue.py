"""All queries, registered by importing the modules that define them."""

from workload import checking, cleaning, featuring, joining, storing, summarising  # noqa: F401
from workload.registry import ORACLES, QUERIES  # noqa: F401
