"""Registered queries, each next to the SQL that checks it."""
