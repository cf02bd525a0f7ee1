"""Column-in, Column-out helpers built from Catalyst expressions."""
