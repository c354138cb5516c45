"""Composite jobs, fixture derivations and the query registry."""
