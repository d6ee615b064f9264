"""Exact ids of whole texts from the byte-level vocabulary, one encoder for each Python worker."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np

#: Fixed values of the vocabulary files.
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256

_CORES: dict = {}


def ranks_of(ranks_path: str) -> dict[bytes, int]:
    """Token bytes -> id; the id is also the merge rank."""
    with open(ranks_path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge_core(ranks_path: str):
    """The vocabulary's merge code; the special string is its one id, as the tokenizers library has it."""
    if ranks_path not in _CORES:
        import public_tokenizers
        import tiktoken

        _CORES[ranks_path] = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks_of(ranks_path),
            special_tokens={SPECIAL: SPECIAL_ID})
    return _CORES[ranks_path]


#: The white space of the vocabulary's word pattern.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Runs of so many are cut out: the merge code's pattern backtracks over them.
LONG_WHITE = 10_000
_LONG_RUN = re.compile(f"[{WHITE}]{{{LONG_WHITE},}}")


def id_encoder(ranks_path: str) -> Callable[[str], bytes]:
    """Text -> its ids as little-endian unsigned 32-bit integers.

    A long run of white space is one word of the pattern, but for its last
    character where a word follows, which belongs to what comes after: it is
    merged as one piece, and the text on either side is encoded by itself.
    """
    core, allowed = merge_core(ranks_path), {SPECIAL}

    def plain(text: str) -> bytes:
        return core.encode_to_numpy(text, allowed_special=allowed).astype("<u4", copy=False).tobytes()

    def encode(text: str) -> bytes:
        if len(text) < LONG_WHITE:
            return plain(text)
        out, at = [], 0
        for run in _LONG_RUN.finditer(text):
            stop = run.end()
            if stop < len(text) and not text.startswith(SPECIAL, stop):
                stop -= 1
            out.append(plain(text[at:run.start()]))
            out.append(np.array(core._core_bpe.encode_single_piece(text[run.start():stop].encode()), "<u4").tobytes())
            at = stop
        out.append(plain(text[at:]))
        return b"".join(out)

    return encode
