"""Table scans, sinks and message sources."""
