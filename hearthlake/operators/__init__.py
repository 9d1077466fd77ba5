"""Dataset operators: each is a pure DataFrame(s) -> DataFrame function."""
