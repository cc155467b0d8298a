"""Publishing result tables."""

from tillroll.sinks.publish import FileSet, TableSet, publish, read_published, write_files, write_jdbc

__all__ = ["FileSet", "TableSet", "publish", "read_published", "write_files", "write_jdbc"]
