"""Column expressions: lenient parsing, money arithmetic and rule predicates."""
