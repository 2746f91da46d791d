"""Typed sources (generated tables, case-study fixtures), views and sinks."""
