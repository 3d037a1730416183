"""kinlink.plans."""
