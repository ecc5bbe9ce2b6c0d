"""Token counts with a public tokenizer whose rank file is a parameter."""

from __future__ import annotations

import base64
from functools import cache

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the public pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@cache
def encoding(path: str = TOKENIZER):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(texts: list[str | None], path: str = TOKENIZER) -> list[int]:
    """Tokens of each text; 0 for NULL and empty ones."""
    encode = encoding(path).encode_ordinary
    return [len(encode(t)) if t else 0 for t in texts]
