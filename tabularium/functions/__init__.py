"""Column expressions: text rules, HTML parsing, templates."""
