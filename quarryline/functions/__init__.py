"""Column functions: text keys and measures, numbers, hashes."""
