"""Independent DuckDB SQL twins of the registered queries (the correctness oracle)."""
