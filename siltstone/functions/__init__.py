"""Column expressions: base-36 ids, lenient coercions, tokens."""
