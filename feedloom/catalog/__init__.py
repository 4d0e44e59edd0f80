"""Registered queries: each a Spark callable and, where SQL can say it, the same in DuckDB SQL."""
