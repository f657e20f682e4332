"""Column helpers, distribution tails and the skew-safe journey primitives."""
