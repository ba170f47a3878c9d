"""Incremental forms of the registry's policies."""
