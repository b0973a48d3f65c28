"""Input tables and file formats."""
