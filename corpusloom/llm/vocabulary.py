"""Tokenizer vocabularies, read once on the driver and handed to the tasks (under 1 MB)."""

from __future__ import annotations

import base64

# Splits a text into the pieces that byte-pair merging works on. Fixed value: it belongs to the vocabulary.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
DEFAULT_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def read_ranks(path: str = DEFAULT_PATH) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes, pieces: str = PIECES):
    """A tiktoken encoding of the ranks file's content."""
    import tiktoken

    merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pieces, mergeable_ranks=merges, special_tokens={})
