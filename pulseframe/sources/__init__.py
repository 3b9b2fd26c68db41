"""Landed JSON records, raw tables, run state."""
