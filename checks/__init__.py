"""Registered queries and the SQL that answers them independently."""
