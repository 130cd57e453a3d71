"""The operators bound to the benchmark tables, one registered query each."""
