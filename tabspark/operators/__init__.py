"""DataFrame operators: preparation, profiling, splitting, scaling, metrics,
training history and the MLP model."""
