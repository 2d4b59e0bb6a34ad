"""Column expressions over text, HTML sections and token arrays."""
