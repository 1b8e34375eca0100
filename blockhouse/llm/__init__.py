"""Training-data operators: near-duplicate joins, packing, scoring, mixing."""
