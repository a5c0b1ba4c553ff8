"""Table-level operators.  Each takes and returns ``DataFrame`` and stays lazy unless it says so."""
