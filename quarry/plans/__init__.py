from quarry.plans.catalog import QUERIES, FLAGSHIP
from quarry.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "FLAGSHIP", "ORACLE_SQL"]
