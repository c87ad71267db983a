"""Where the vocabulary files of public tokenizers are."""

from __future__ import annotations


def tokenizer_path(name: str) -> str:
    """Path of a vocabulary file of the installed ``public_tokenizers`` package."""
    import public_tokenizers
    return public_tokenizers.path(name)
