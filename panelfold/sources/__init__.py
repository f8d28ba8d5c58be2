"""Landed files and tables in, tables and artefacts out."""
