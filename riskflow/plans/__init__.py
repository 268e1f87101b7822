"""What a user calls: layer builders, publishing, full refresh and anomaly detectors."""
