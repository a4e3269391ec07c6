"""The star-schema jobs, composed from the operators."""
