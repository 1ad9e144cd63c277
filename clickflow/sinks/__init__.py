"""Result sinks: JDBC tables, managed tables, console preview and keyed tables."""

from clickflow.sinks.keyed import KeyedTable
from clickflow.sinks.tables import preview, publish_table, write_jdbc

__all__ = ["KeyedTable", "preview", "publish_table", "write_jdbc"]
