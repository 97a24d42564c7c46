"""Readers and writers: page corpora, raw season tables, seeds, audits."""
