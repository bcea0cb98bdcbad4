"""Functions that SQL text can call: row filters, table-valued functions, model calls."""
