"""Training-data operators: one module per operator, ``queries`` registers their digests."""
