"""Column expressions: name cleaning, character n-grams and fuzzy scores."""
