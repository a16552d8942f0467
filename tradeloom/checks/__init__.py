"""Registered queries and the DuckDB SQL that each is checked against."""
