"""DataFrame -> DataFrame transformations, one module per concern."""
