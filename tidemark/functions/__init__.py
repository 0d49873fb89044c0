"""Column expressions: time, ids and text. All built-ins, no UDFs."""
