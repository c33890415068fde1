"""SPARQL text to algebra, and algebra to DataFrame plans."""
