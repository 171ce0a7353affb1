"""Column expressions: identities, payload items and response attribution."""
