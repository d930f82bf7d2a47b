"""End-to-end jobs composed of the operators: layers on disk, reports and training."""
