"""Byte-level BPE files of the ``tokenizers`` library, applied piece by piece."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from gridscope.llm.bpe import PieceCoder


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte.

    Visible characters of Latin-1 stand for themselves, all other bytes in order for the characters from 256 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(256 + n): b for n, b in enumerate(hidden)}}


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and how many each has."""
    counts = np.array([len(ids) for ids in lists], dtype=np.int64)
    return np.array([i for ids in lists for i in ids], dtype=np.int64), counts


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of the vocabulary."""
    alphabet = byte_alphabet()
    with open(path, encoding="utf-8") as held:
        vocabulary = json.load(held)["model"]["vocab"]
    tokens = [b""] * (max(vocabulary.values()) + 1)
    for token, number in vocabulary.items():
        tokens[number] = bytes(alphabet[c] for c in token)
    return tokens


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    """Pieces by the model of the file; as they are cut and spelt here, the library need not cut them again."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path).model
    points = np.zeros(256, dtype="<u4")
    for character, byte in byte_alphabet().items():
        points[byte] = ord(character)

    def encode(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spelt = points[data].tobytes().decode("utf-32-le")
        return flat([[token.id for token in model.tokenize(spelt[a:b])] for a, b in zip(starts.tolist(), ends.tolist())])

    return PieceCoder(encode)
