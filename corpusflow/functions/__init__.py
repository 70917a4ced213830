"""Column functions: text, term rules, venues and records."""
