"""DataFrame → DataFrame operators."""
