"""Column functions: text cleaning, numbers and their text forms."""
