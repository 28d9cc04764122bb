"""codexgrid: analytics on versioned, hierarchically numbered documents, on Spark."""
