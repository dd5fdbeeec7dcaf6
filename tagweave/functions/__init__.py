"""Column expressions: rule text, conditions, dates, money and score bands."""
