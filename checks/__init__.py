"""One query per operator on the driver's tables, each with an equivalent DuckDB statement."""
