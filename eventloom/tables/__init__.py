"""Typed-table specifications, one module per diagnostic log."""
