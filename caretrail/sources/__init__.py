from caretrail.sources.tables import read_table, TABLES
from caretrail.sources import domain

__all__ = ["read_table", "TABLES", "domain"]
