"""Registered queries: one per operator, each with the SQL that must give the same rows."""
