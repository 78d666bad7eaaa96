"""Registered queries: each pairs a Spark plan built from widetab operators
with (where SQL can express it) an equivalent DuckDB SQL oracle."""
