"""The output tables, each one lazily built DataFrame."""
