"""Part of groundset; see README.md."""
