"""Demonstration inputs, queries over them and the SQL that checks the queries."""
