"""Reports and jobs as registered queries."""

from . import classification, ingest, settlement, smsc_reports, usage_reports  # noqa: F401  (register their queries)
from .catalogue import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
