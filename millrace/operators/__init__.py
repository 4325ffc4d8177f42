"""DataFrame to DataFrame operators."""
