"""Registered queries over the supplied tables, with their reference SQL."""
