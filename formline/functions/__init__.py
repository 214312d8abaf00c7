"""Column expressions and schema-only helpers; nothing here starts a job."""
