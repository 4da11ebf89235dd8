"""Operators on texts for training language models; nothing else in the library imports them."""
