"""Role tables in, report tables out."""
