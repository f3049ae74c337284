"""Operators that prepare text for language-model training; nothing outside this folder imports it."""
