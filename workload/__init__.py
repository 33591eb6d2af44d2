"""Chain-shaped inputs derived from the given tables, and the queries over them."""
