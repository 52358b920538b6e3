"""Column expressions: text, number, time and code cleaning. No UDFs."""
