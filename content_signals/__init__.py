"""DataFrame operators for tables of content sources."""
