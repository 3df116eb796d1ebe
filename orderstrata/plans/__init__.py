"""Stages that read tables, apply operators and write tables, and the run over all of them."""
