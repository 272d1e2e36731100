"""Column functions: rounding, dates, JSON, arrays, strings and UDF forms."""
