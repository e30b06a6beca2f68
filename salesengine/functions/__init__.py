"""Column functions; every one is a native expression."""
