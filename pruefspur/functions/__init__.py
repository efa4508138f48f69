"""Column expressions: value conversion, text cleaning, names, charsets."""
