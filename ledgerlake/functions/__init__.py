"""Column rules shared by the silver and gold layers (all built-in functions)."""
