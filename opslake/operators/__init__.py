"""DataFrame operators: expectations, diffs, metric views, masks, similarity search."""
