"""Readers. Every one has an explicit schema; what can't be read is a row or a null, not a crash."""
