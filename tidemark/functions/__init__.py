"""Column expressions: scalar formulas and gated row frames."""
