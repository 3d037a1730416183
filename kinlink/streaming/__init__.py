"""kinlink.streaming."""
