"""SPARQL's values and functions as Spark columns."""
