"""Column expressions: no UDFs, so they stay inside generated code."""
