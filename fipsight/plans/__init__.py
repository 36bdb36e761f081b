"""End-to-end chains and the bindings of every query to the test tables."""
