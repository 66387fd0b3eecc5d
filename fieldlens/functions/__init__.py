"""Column-expression helpers (PostgreSQL / VBA semantics on built-in Spark functions)."""
