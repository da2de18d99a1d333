"""Operators for preparing language-model training data, their queries and SQL.  Nothing outside imports this."""
