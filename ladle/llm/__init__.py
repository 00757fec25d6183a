"""Training-data operators: one module per operator, one registered query each."""
