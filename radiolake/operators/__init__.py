"""Frame operators."""
