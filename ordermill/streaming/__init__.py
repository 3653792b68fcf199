"""Jobs that take in data as it arrives."""
