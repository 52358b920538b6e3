"""CSV landings and catalog tables."""
