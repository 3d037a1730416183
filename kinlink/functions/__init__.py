"""kinlink.functions."""
