"""quadrille: SPARQL 1.1 over RDF quads, compiled to Spark DataFrame plans."""
