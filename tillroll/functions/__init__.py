"""Column expressions: text, calendar, rounding and labels."""
