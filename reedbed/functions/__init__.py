"""Column builders and ordering helpers shared by the operators."""
