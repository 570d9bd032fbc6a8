"""Byte-level BPE ids with a cache of pieces.

A piece runs from one single space to the next.  The pre-tokenizer of this family
never joins text over a space that stands between two other non-space characters,
so the ids of a text are those of its pieces, one after another.  Texts for which
that doesn't hold (runs of white space, a space at an end) are encoded as a whole.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import tiktoken

#: The pre-tokenizer's pattern, a fixed value of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for
    themselves, the others for code points from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceEncoder:
    """Texts to little-endian unsigned 32-bit ids; strings of special tokens are text."""

    def __init__(self, path: str, most_pieces: int = 300_000):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocab.items() if all(c in alphabet for c in token)}
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        if any(vocab[m] != 256 + i for i, m in enumerate(merged)):
            raise ValueError(f"the ids in {path} don't follow the order of its merges")
        self.bpe = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(vocab.values()) + 1
        self.most = most_pieces
        self.first: dict[str, bytes] = {}
        self.later = _Pieces(self)

    def whole(self, text: str) -> bytes:
        return np.asarray(self.bpe.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        head, *rest = text.split(" ")
        if not rest or not head or head[-1].isspace() or head[0].isspace():
            return self.whole(text)
        if len(self.later) > self.most:
            self.later.clear()
        try:
            return self.whole(head) + b"".join([self.later[p] for p in rest])
        except TypeError:  # a piece that can't stand alone
            return self.whole(text)

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id; none for ids that no text has."""
        own = self.bpe.token_byte_values()
        out = [b""] * self.size
        for token in own:
            out[self.bpe.encode_single_token(token)] = token
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.bpe.decode_bytes(ids.tolist()).decode("utf-8")


class _Pieces(dict):
    def __init__(self, encoder: PieceEncoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes | None:
        alone = piece and not piece[0].isspace() and not piece[-1].isspace()
        self[piece] = made = self.encoder.whole(f" {piece}") if alone else None
        return made


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder per worker process and vocabulary."""
    return PieceEncoder(path)
