"""Writers and publishing."""
