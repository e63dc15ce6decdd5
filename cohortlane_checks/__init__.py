"""Registered queries and the independent SQL each of them is compared with."""
