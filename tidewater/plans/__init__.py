"""Concrete jobs over the test tables and the query registry."""
