"""Column expressions: text, dates, numbers, labels, keys, distances and scores."""
