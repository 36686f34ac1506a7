"""Composite jobs: syncs, request batches, registration, discovery."""
