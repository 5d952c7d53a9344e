"""Layered yearly-file warehouse on Spark: text files, typed lake, star schema, marts."""
