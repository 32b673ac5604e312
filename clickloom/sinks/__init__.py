"""Writers for result tables and streams."""
