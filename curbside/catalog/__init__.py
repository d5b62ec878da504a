from curbside.catalog.oracle import ORACLE_SQL
from curbside.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
