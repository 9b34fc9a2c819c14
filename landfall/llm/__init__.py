"""Operators of a training-data pipeline: secrets, near duplicates, quality, chats, archives, tokens, personal data."""
