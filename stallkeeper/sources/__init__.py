"""Readers and writers of archives, index hits, tables and run bookkeeping."""
