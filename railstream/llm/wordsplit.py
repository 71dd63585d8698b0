"""Splitting a text into words that a word-level BPE tokenizer encodes independently.

White space always ends a word for the tokenizer in use, so a text may be encoded run by run. Runs
of plain letters, digits and ASCII signs are cut further, by the tokenizer's own pre-tokenization
pattern, and lower-cased as it does; the number of distinct words is then about half. Any other
run (other scripts, combining marks, special-token strings) is left whole for the tokenizer.
"""

from __future__ import annotations

import os

import regex

# The pre-tokenization pattern of the tokenizer file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

# Letters that are their own NFC form and whose lower case is one letter of the same range.
_PLAIN = regex.compile(r"[\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ŷ]+")
_CUT = regex.compile(PATTERN)


def is_plain(text: str) -> bool:
    """Whether a run or word has only letters that are their own normal form, digits and signs."""
    return "<|" not in text and _PLAIN.fullmatch(text) is not None


def words_of(run: bytes) -> list[str]:
    """The words of one run without ASCII white space."""
    text = run.decode("utf-8")
    if not is_plain(text):
        return [text]
    return _CUT.findall(text.lower())


def load_tokenizer(path: str):
    """The tokenizer of a file, on one thread, without truncation and padding.

    ``path`` must be readable where it is called; it is a parameter of every operator.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file ``name`` is installed."""
    import public_tokenizers
    return public_tokenizers.path(name)
