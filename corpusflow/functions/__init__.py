"""Column functions: text, cleaners, seeded picks, strict JSON."""
