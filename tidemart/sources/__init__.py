"""Readers of the logs, the routing config and the dictionary."""
