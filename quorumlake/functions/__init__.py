"""Column expressions: text normalisation, similarity, row extraction."""
