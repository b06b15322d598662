"""siltworks: warehouse building blocks for Spark DataFrames.

Column functions, table operators, data-quality checks, table comparison,
calendars, sources and sinks, and plans that compose them into staging,
identity, golden-record and star-schema tables.  Everything is a plain
function over ``Column`` / ``DataFrame``; no Python UDF is used anywhere.
"""
