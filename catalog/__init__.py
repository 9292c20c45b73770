"""Registered queries, their input tables and equivalent SQL."""
