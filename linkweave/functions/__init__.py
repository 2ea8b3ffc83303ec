"""Column functions: from Columns to Columns, without actions."""
