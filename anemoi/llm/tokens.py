"""Token ids of whole texts from a vocabulary file of merge ranks (byte-level BPE).

The splitting pattern of this vocabulary never joins what white space parts, but for one
space before a word. A text is therefore cut into space-led words and white-space runs,
and each distinct piece is encoded once per Python worker; ids come out as little-endian
uint16 bytes, joined without a Python object per token. Texts whose white space is single
spaces and line ends between words, nearly all, are cut by plain string splits.
"""

from __future__ import annotations

import base64
import functools
import re
import struct

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EOD = 50256            # the id that the vocabulary leaves free: end of document
CACHED = 400_000       # pieces a worker remembers

# fixed value: the public splitting pattern of the vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_OTHER = re.compile("[\\t\\x0b-\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_PIECE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}H", *ids)


class _Pieces(dict):
    def __init__(self, encoding):
        super().__init__()
        self.encoding = encoding

    def __missing__(self, piece: str) -> bytes:
        ids = _bytes(self.encoding.encode_ordinary(piece))
        if len(piece) > 64:            # rare and large: not worth remembering
            return ids
        if len(self) >= CACHED:
            self.clear()
        self[piece] = ids
        return ids


@functools.lru_cache(maxsize=2)
def encoding(path: str = VOCABULARY):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class _Led(_Pieces):
    """The same for words with a space before them."""

    def __missing__(self, word: str) -> bytes:
        ids = _bytes(self.encoding.encode_ordinary(" " + word))
        if len(word) <= 64:
            if len(self) >= CACHED:
                self.clear()
            self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _pieces(path: str) -> tuple[_Pieces, _Led]:
    return _Pieces(encoding(path)), _Led(encoding(path))


def _plain(text: str) -> bool:
    """White space is single spaces and line ends, each between two words."""
    return not (text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text
                or "\n\n" in text or _OTHER.search(text))


def encode(text: str | None, path: str = VOCABULARY) -> bytes:
    """Token ids of a text as uint16 bytes (null: none)."""
    if not text:
        return b""
    bare, led = _pieces(path)
    if not _plain(text):
        return b"".join(map(bare.__getitem__, _PIECE.findall(text)))
    out = []
    for line in text.split("\n"):
        first, *words = line.split(" ")
        out.append(bare[first] + b"".join(map(led.__getitem__, words)))
    return bare["\n"].join(out)
