"""DataFrame-to-DataFrame steps: rules, gate, dimensions, fact, cells and flow."""
