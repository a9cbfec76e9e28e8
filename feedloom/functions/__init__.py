"""Column functions: every one is ``Column -> Column``."""
