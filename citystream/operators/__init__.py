"""DataFrame -> DataFrame operators; each runs on batch and streaming inputs
unless its docstring says otherwise."""
