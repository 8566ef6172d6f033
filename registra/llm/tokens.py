"""Token ids of the public byte-level BPE vocabulary, one encoder per Python worker.

The ids are those of the ``tokenizers`` file. The worker encodes with the same vocabulary in rank
form, which is several times faster and gives the same ids; texts for which the two could differ
(they hold the text of a special token, or a run of many bytes without white space, on which the
rank encoder is quadratic) go through ``tokenizers`` itself.
"""

from __future__ import annotations

import functools
import os

import numpy as np

#: Longest run without white space that the rank encoder gets.
LONG_RUN = 2000


@functools.cache
def _slow(json_path: str):
    """The ``tokenizers`` encoder, about 30 MB a worker; loaded when the first text needs it."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(json_path)


@functools.cache
def _fast(rank_path: str):
    import base64

    import public_tokenizers
    import tiktoken

    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_paths() -> tuple[str, str]:
    import public_tokenizers as p

    return p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken")


def encode(text: str, paths: tuple[str, str | None]) -> np.ndarray:
    """uint32 ids of a text, without special tokens added."""
    if not paths[1] or "<|" in text or (len(text) > LONG_RUN and max(map(len, text.split()), default=0) > LONG_RUN):
        return np.array(_slow(paths[0]).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.array(_fast(paths[1]).encode_ordinary(text), np.uint32)
