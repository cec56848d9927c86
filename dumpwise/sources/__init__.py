"""Sources: catalogue dump tables, written reports, site space-usage JSON, test catalogue."""
