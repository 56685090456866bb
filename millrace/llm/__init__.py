"""Operators for preparing training corpora; nothing else in millrace imports this package."""
