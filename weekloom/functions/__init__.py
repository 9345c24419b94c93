"""Column expressions: text, dates and money."""
