"""End-to-end flows, and the binding of the operators to the test tables."""
