"""Streaming runs of the job plans."""
