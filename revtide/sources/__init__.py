"""Reading and writing: raw landing zone, JSON payload pages, tables."""
