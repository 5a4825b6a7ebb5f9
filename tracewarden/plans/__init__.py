"""Reusable plan shapes: running values, bounded top-k, skew-safe lookups, iteration."""
