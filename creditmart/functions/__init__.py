"""Column expressions: each takes columns and returns a Column, safe under ANSI mode."""
