"""Readers. Every one uses an explicit schema; none infers."""
