"""Column expressions: text clean-up, revert rules, features, tokens."""
