"""Token ids of whole texts by a public vocabulary (never trained here).

The reference ids are those of the ``tokenizers`` library with TOKENIZER and
``add_special_tokens=False``; a special token's string inside a text is its id, as
the library has it by default. The same vocabulary is also given as merge ranks, which ``tiktoken``
applies several times as fast with equal ids (the tests compare them), so that
is what runs in the tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
# Special tokens of the vocabulary and their ids.
SPECIAL = {"<|endoftext|>": 50256}
SLICE_BYTES = 2 << 20  # text encoded at a time in a task


@cache
def _encoding(name: str):
    """The vocabulary, loaded once a worker process."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def encoded(texts: list[str], ranks: str = RANKS) -> Iterator[np.ndarray]:
    """uint32 ids of each text."""
    encoding = _encoding(ranks)
    for text in texts:
        yield encoding.encode_to_numpy(text, allowed_special="all")


def sliced(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in slices of bounded size, one text at least; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pa.compute.binary_length(texts).to_numpy())
    lo = 0
    while lo < len(texts):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most_bytes, side="right"))
        hi = max(hi, lo + 1)
        yield lo, texts.slice(lo, hi - lo).to_pylist()
        lo = hi
