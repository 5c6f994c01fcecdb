"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary's ranks file gives the same ids as its JSON form and encodes
several times faster. ``encoder`` takes strings of added tokens as ordinary text
unless they are given to it; ``added_tokens`` reads them from the JSON.
"""

from __future__ import annotations

import sys
import types
from array import array

END_ID = 2
# Fixed value: the vocabulary's pre-tokenizer, in its form without backtracking.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def worker_cache() -> types.ModuleType:
    """One namespace for each Python process, kept between tasks."""
    return sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def added_tokens(path: str | None = None) -> dict[str, int]:
    """Ids of the strings that the JSON form takes out of a text before all else."""
    import json
    with open(path or vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        found = json.load(f)["added_tokens"]
    plain = all(not t[k] for t in found for k in ("single_word", "lstrip", "rstrip", "normalized"))
    if not plain:
        raise ValueError("added tokens that are not matched as they stand")
    return {t["content"]: t["id"] for t in found}


def encoder(path: str, added: dict[str, int] | None = None):
    """``text -> ids`` as bytes of little-endian unsigned 32-bit numbers; the
    strings in ``added`` become their ids."""
    added = added or {}
    made = worker_cache().__dict__.setdefault("encoders", {})
    key = (path, *sorted(added.items()))
    if key not in made:
        import base64

        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        made[key] = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    whole = made[key]

    def ids(text: str) -> bytes:
        some = any(t in text for t in added)
        found = array("I", whole.encode(text, allowed_special="all") if some else whole.encode_ordinary(text))
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()
    return ids
