"""End-to-end jobs (E1-E12): plain functions run in order."""
