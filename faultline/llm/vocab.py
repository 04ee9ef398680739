"""Reads the files of public byte-level tokenizers."""

from __future__ import annotations

import base64
import json


def _byte_signs() -> dict[str, int]:
    """The sign by which such a file writes each byte: itself if printable, else the next code point from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    signs, spare = {chr(b): b for b in plain}, 256
    for b in range(256):
        if chr(b) not in signs:
            signs[chr(spare)] = b
            spare += 1
    return signs


def read_json(path: str) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]], dict[bytes, int]]:
    """Tokens with ids, merges in order, and special tokens with ids, of a byte-level ``tokenizers`` file."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    signs = _byte_signs()
    raw = lambda text: bytes(signs[x] for x in text)
    special = {x["content"].encode(): x["id"] for x in whole["added_tokens"]}
    tokens = {raw(x): i for x, i in whole["model"]["vocab"].items() if x.encode() not in special}
    pairs = (x.split(" ") if isinstance(x, str) else x for x in whole["model"]["merges"])
    return tokens, [(raw(a), raw(b)) for a, b in pairs], special


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens with ranks, which are their ids, of a ``tiktoken`` file."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
