"""Readers and writers: Parquet test tables, JDBC, index-style sinks, CoNLL."""
