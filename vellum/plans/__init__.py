"""The registered queries, with DuckDB SQL for checking them."""
