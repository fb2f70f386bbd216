"""Queries bound to the test tables, each with the SQL that checks it."""
