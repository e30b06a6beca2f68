"""Operators on sales rows: cleaning, keyed writes, ranking, sinks."""
