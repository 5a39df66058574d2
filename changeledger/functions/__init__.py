"""Column-level building blocks (all built-in Catalyst expressions, no UDFs)."""
