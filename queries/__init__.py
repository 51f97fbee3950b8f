"""Registered queries: the library applied to the test tables, with an SQL twin for each."""
