"""Queries of the library over the provided tables, with their SQL counterparts."""
