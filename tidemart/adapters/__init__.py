"""Adapters that express other data sets as change and behaviour logs."""
