"""Part of lumenspan: plans."""
