"""DataFrame-to-DataFrame steps: normalise, filter, store, index, search."""
