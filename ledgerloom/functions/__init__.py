"""Column functions: text parsing, money, calendar attributes."""
