"""Part of lumenspan: operators."""
