"""Column expressions: frame headers, record decoding, time columns."""
