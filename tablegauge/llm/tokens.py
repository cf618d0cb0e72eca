"""Token ids of texts, as bytes."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import tiktoken

#: Fixed value: the id that ends each document.
END_ID = 2
#: Fixed value: the pre-token pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed value: what the pattern takes as white space.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The pattern fails from about a million characters of white space on.
LONG_SPACE = 100_000


@lru_cache(maxsize=2)
def encoder(ranks_path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file, with the added tokens of the JSON file of that name beside it."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    added = json.loads(Path(ranks_path).with_suffix(".json").read_text(encoding="utf-8"))["added_tokens"]
    special = {token["content"]: token["id"] for token in added}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def text_ids(encoding: tiktoken.Encoding, text: str, long_space: int = LONG_SPACE) -> list[int]:
    """Ids of a text. The pattern backtracks over white space, so runs of `long_space` and more are cut out.

    The pattern takes such a run as one piece, but for its last character where anything but an added token follows.
    """
    ids, done = [], 0
    if len(text) >= long_space:
        added = tuple(encoding.special_tokens_set)
        for run in re.finditer(f"[{_SPACE}]{{{long_space},}}", text):
            last = run.end() == len(text) or text.startswith(added, run.end())
            end = run.end() - (not last)
            ids += encoding.encode(text[done : run.start()], allowed_special="all")
            ids += encoding._encode_single_piece(text[run.start() : end])
            done = end
    return ids + encoding.encode(text[done:], allowed_special="all")


def document_ids(encoding: tiktoken.Encoding, text: str | None, end_id: int = END_ID) -> np.ndarray:
    """Ids of a text and the end id, unsigned 32-bit; a null text has the end id only."""
    return np.array([*(text_ids(encoding, text) if text else ()), end_id], dtype="<u4")


def piece_bounds(n_ids: int, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: all of `size` but for the first."""
    first = n_ids % size or min(size, n_ids)
    yield 0, first
    for start in range(first, n_ids, size):
        yield start, size
