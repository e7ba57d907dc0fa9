"""Readers: payment messages and the tables derived from them."""
