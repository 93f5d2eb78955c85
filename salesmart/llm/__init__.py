"""Operators for preparing language-model training text at scale.

Nothing outside this folder imports it; ``queries`` holds the registered
queries and their SQL.
"""
