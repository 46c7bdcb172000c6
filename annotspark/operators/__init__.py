"""Part of annotspark."""
