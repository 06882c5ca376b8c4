"""Column expressions: tokens, typed text, declared types."""
