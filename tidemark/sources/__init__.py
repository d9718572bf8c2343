"""Raw sources, the landing table, silver tables and the mart sink."""
