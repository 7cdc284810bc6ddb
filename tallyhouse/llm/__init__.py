"""Operators that prepare training text: cleaning, scoring, de-duplication, tokens, archives."""
