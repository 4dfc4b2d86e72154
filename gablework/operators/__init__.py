"""Table operators: each takes a DataFrame and returns one, or a fitted step."""
