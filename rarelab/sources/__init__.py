"""Table scans, CSV round trips, dense keys and the study fixtures."""
