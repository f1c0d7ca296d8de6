"""Column expressions: text cleaning, id parsing, numbers, outcome labels."""
