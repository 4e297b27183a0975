"""Writers. Bodies stay distributed; nothing is gathered into one row or task."""
