"""Column functions and the few Arrow-backed ones."""
