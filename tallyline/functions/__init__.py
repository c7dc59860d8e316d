"""Column helpers and skew handling shared by the operators."""
