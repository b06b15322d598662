"""Compositions of operators: staging, calendars, events, identity, golden record, star schema, marts."""
