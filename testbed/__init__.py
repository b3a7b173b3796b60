"""Telematics tables derived from the given test tables, with matching DuckDB SQL."""
