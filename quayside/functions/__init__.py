"""Column builders and small driver-side helpers used by the operators."""
