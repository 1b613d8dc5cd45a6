"""Token ids of a public vocabulary file, in Arrow batches."""

from __future__ import annotations

import json
from functools import lru_cache

import tiktoken

BYTE_BPE = "byte_bpe_50k.json"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(BYTE_BPE)


def _byte_symbols() -> dict[str, int]:
    """The printable stand-in that byte-level vocabularies use for each byte: itself if printable, else the next free one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE vocabulary of a tokenizers JSON file, whose ids are its merge ranks.

    The file's own library gives the same ids at a third of the speed; the tests compare the two.
    """
    import public_tokenizers

    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    special = {t["content"]: t["id"] for t in said["added_tokens"]}
    symbols = _byte_symbols()
    ranks = {bytes(symbols[c] for c in token): n for token, n in said["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def encode(text: str, path: str, *, specials: bool) -> list[int]:
    """Ids of a text; with ``specials`` the strings of special tokens in it become those tokens, else they are ordinary text."""
    coder = encoding(path)
    if specials and any(s in text for s in coder.special_tokens_set):
        return coder.encode(text, allowed_special="all")
    return coder.encode_ordinary(text)
