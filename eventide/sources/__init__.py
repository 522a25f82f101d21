"""Sources: file readers (A1-A5), literal rows (A4) and record views over the driver tables."""
