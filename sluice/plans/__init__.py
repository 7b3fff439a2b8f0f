"""Whole loads, composed of sources and operators."""
