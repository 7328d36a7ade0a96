"""Column functions: business rules, date arithmetic, exact rounding."""
