"""Shared physical shapes: top-k, nearest neighbours, postings, change logs."""
