"""Configuration and the end-to-end composition of the operators."""
