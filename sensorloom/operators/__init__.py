"""DataFrame operators; each takes and returns DataFrames and plans lazily unless it says so."""
