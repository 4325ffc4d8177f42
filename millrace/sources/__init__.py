"""Readers of annotation formats."""
