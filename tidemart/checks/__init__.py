"""Registered queries over the order and event tables, and the SQL they must agree with."""
