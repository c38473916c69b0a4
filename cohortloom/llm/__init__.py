"""Operators for preparing large text collections; one module per operator."""
