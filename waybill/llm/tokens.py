"""Token ids of a public byte-level BPE vocabulary, in Arrow batches."""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np

VOCABULARY = "byte_bpe_50k"
END = 1


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY, added: bool = False):
    """Text to a numpy array of ids, once per worker.

    ``byte_bpe_50k.tiktoken`` lists the vocabulary of ``byte_bpe_50k.json`` as
    ranks. tiktoken gives the ids that ``tokenizers`` gives, several times as
    fast; the tests hold one against the other. The string of an added token
    (``<|endoftext|>``) in a text is ordinary text, as with ``encode_special_tokens``;
    with ``added`` it is that token's id, as ``tokenizers`` gives it unaltered.
    """
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    special = {}
    if added:
        with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as held:
            special = {t["content"]: t["id"] for t in json.load(held)["added_tokens"]}
    own = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: np.asarray(own.encode_to_numpy(text, allowed_special="all", disallowed_special=()), dtype="<u4")
