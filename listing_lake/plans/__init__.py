"""Runs over storage (pipeline) and the registered queries with their SQL."""
