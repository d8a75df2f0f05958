"""Column -> Column builders; Catalyst sees plain expressions, no UDFs."""
