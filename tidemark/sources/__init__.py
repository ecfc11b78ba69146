"""Readers: delimited files, landed or JDBC tables, cached extracts and the message topic."""
