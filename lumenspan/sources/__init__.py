"""Part of lumenspan: sources."""
