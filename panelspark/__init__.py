"""Company-by-date panel analytics as DataFrame -> DataFrame functions."""
