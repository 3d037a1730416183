"""kinlink.operators."""
