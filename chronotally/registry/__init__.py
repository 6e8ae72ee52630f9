"""The registered queries, each next to the SQL it is compared with."""

from chronotally.registry import batch, cleaning, streams  # noqa: F401  (they register)
from chronotally.registry.base import ORACLE, QUERIES
