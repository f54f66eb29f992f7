"""Column functions: every one takes and returns Columns, so jobs stay inside generated code."""
