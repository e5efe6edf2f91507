"""Readers, writers and the cost-export load."""
