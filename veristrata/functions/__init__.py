"""Part of the validation engine."""
