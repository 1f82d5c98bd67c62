"""Sources and sinks at the edge: CSV corpus files, sitemaps, feeds, caches, robots rules, captured pages."""
