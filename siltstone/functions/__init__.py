"""Column functions: text, dates, arithmetic, vectors, text encoding."""
