"""Operators of a training-data pipeline over documents, pages, chats and vectors."""
