"""Where results go: catalog tables on files, or a database over JDBC."""

from paytally.sinks.jdbc import JdbcTarget
from paytally.sinks.warehouse import Warehouse, insert_ignore, merge_staged, stage

__all__ = ["JdbcTarget", "Warehouse", "insert_ignore", "merge_staged", "stage"]
