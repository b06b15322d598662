"""Source registry, loads, stored tables and catalog reports."""
