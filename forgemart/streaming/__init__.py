"""Structured Streaming counterparts of the silver cleaning, the commit counts and the fact load."""
