"""Column expressions: text cleaning, rule tables, calendar, salary."""
