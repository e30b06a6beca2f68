"""Summary tables, checks and dashboard reads, as DataFrame plans."""
