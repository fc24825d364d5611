"""Writers and run metrics."""
