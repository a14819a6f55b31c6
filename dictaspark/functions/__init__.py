"""Column functions: text, personal data and statistics."""
