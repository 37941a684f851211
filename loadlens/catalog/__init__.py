"""Registered queries over the test tables, and SQL that gives the same rows."""
