"""Query catalogue on the driver tables and its SQL oracle."""

from cohortmine.plans.catalog import QUERIES, flagship
from cohortmine.plans.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
