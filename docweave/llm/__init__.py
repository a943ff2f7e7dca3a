"""Training-data pipeline operators.

Nothing outside this folder imports it: ``__spark_entry__`` adds its queries
when it is present.  Each ``opN_*`` module holds one operator with its own
interface and, at the end, the thin query that applies it to a whole table.
"""
