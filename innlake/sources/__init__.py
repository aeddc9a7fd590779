"""Readers, writers, message encoding and the booking views."""
