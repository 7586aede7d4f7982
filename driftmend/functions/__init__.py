"""Column expressions shared by the operators: names, types, keys, digests, messages."""
