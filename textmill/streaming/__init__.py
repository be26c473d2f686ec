"""Structured Streaming forms of the guard rules and the rate limiter."""
