"""DataFrame operators: classification, projection, filters, offsets, routing, metrics."""
