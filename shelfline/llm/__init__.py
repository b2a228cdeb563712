"""Training-data operators: ten documents / pages / embeddings operators and
the queries that apply them.  Nothing else in the library imports this."""
