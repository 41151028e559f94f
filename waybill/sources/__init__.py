"""Inputs, provenance and outputs."""
