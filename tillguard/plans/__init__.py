"""Composite plans: the reference's end-to-end jobs as DataFrame functions."""
