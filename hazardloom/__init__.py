"""Part of the hazardloom package."""
