"""Token ids of the byte-level BPE in a ``tokenizers`` JSON file.

The file's vocabulary lists byte strings in merge order, so it doubles as a
rank table; ids are computed from it by the faster of the two installed
libraries that read such tables.  They are the ids that ``tokenizers`` gives
for the unchanged file with ``add_special_tokens=False`` (tests compare both on
whole tables): a string that the file adds as a token, standing in a text, is
that token's id.  With ``added=False`` such a string is ordinary text.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DEFAULT = "byte_bpe_50k.json"


def vocabulary_path(name: str = DEFAULT) -> str:
    return public_tokenizers.path(name)


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE files write each byte as one printable character."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(shifted)}


@lru_cache(8)
def encoder(path: str, added: bool = True) -> tiktoken.Encoding:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    to_byte = _byte_of_char()
    ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special if added else {})


@lru_cache(8)
def slow_encoder(path: str, added: bool = True) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not added
    return t


def encode(path: str, text: str, added: bool = False) -> np.ndarray:
    """The ids of a text, as unsigned 32-bit numbers; ``added`` recognises the file's added tokens in the text."""
    try:
        return encoder(path, added).encode_to_numpy(text, allowed_special="all", disallowed_special=())
    except (ValueError, RuntimeError):  # its pattern matcher gives up on extreme runs of white space
        return np.array(slow_encoder(path, added).encode(text, add_special_tokens=False).ids, np.uint32)


def vocabulary_size(path: str) -> int:
    """One more than the largest id."""
    return encoder(path).n_vocab


def decode(path: str, ids: np.ndarray) -> str:
    return encoder(path).decode_bytes(ids.tolist()).decode()
