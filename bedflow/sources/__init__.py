"""Sources (driver tables, calendar, fixture views, JSON documents) and sinks."""
