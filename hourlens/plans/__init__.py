"""Registered queries: each a Spark job over the driver tables, most of them
paired with the SQL that must give the same rows."""
