"""User-level analytics operators for Spark tables and streams."""
