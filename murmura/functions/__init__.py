"""Column expressions: text cleaning, predicates, n-grams, vectors."""
