"""Operational sources and their extraction into staging."""
