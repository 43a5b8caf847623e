"""Composed jobs: staging, enrichment, marts, named queries, model studies."""
