"""Registered queries with their SQL oracles, and helpers that shape plans."""
