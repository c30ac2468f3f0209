"""Registered queries over the benchmark tables, with an independent SQL statement for each."""
