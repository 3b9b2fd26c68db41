"""Reusable relational operators over any keyed or daily frame."""
