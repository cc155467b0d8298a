"""Test-table mapping, registered queries and their SQL counterparts."""
