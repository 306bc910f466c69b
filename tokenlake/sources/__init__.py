"""Corpus scans, token tables, tokenizer files and job checkpoints."""
