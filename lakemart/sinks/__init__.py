"""Writing tables: landing, quarantine, replace, upsert and reports."""
