"""DataFrame-to-DataFrame operators, one module per layer of the warehouse."""
