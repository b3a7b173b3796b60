"""Whole jobs: windows, incremental loads, rollup refresh, serving queries."""
