"""Column functions: blank-aware arithmetic, dates, text."""
