"""Registered queries over the test tables, and the DuckDB SQL that checks them."""
