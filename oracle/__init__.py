"""DuckDB SQL that computes the registered queries independently."""
