"""The daily jobs, composed from operators."""
