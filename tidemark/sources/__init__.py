"""Readers, writers and the scratch location shared by all executors."""
