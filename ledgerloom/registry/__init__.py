"""All registered queries. Importing this package fills the registry."""

from ledgerloom.registry import flows, gold, quality, reruns, silver  # noqa: F401
from ledgerloom.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
