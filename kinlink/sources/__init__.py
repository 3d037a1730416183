"""kinlink.sources."""
