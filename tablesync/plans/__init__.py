from tablesync.plans import conversions, landing, merges, reads, redaction  # noqa: F401
from tablesync.plans.base import REGISTRY

__all__ = ["REGISTRY"]
