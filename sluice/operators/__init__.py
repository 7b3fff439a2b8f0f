"""DataFrame-to-DataFrame operators and table writes."""
