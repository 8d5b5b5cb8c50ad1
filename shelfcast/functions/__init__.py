"""Column functions and reusable aggregates."""
