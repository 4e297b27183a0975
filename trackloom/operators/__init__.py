"""Relational operators over tracks, prompts, response logs and records."""
