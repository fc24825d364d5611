"""Readers: message streams, alert envelopes and CSV history."""
