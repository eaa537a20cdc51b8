"""Queries over the test tables and the DuckDB SQL they are compared with."""
