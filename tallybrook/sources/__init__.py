"""Readers and writers: item pages, message envelopes, lake folders."""
