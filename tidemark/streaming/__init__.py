"""Structured Streaming jobs over metric messages and observation records."""
