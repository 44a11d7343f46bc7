"""Where the installed tokenizers' files are; other places can be given to the operators.

The package is imported when a file is asked for, so the other operators work without it.
"""

from __future__ import annotations


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    """How the byte-level vocabularies cut a text."""
    import public_tokenizers

    return public_tokenizers.PATTERN
