"""Byte-level BPE: words of a text, and the ids of words.

A text is cut into words that the tokenizer never joins: a word takes the single
space in front of it along, white space that belongs to no word stands alone. So
the ids of a text are the ids of its words in order, and each distinct word needs
to be encoded only once.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Sequence
from functools import lru_cache
from pathlib import Path

import numpy as np
import tiktoken

# What the tokenizer's splitting pattern takes for white space, and the pattern.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_RUNS = re.compile(f"([{SPACES}]+)")
_RARE = re.compile("[\t\x0b\x0c\r\0\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_EDGE = re.compile(f"[{SPACES}]")


def words(text: str) -> list[str]:
    """The words of a text without special strings; joined they give the text."""
    if not text:
        return []
    plain = not (
        "  " in text or "\n\n" in text or "\n " in text or " \n" in text
        or _EDGE.match(text[0]) or _EDGE.match(text[-1])
    )
    if plain and not _RARE.search(text):
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
    parts = _RUNS.split(text)
    out = [parts[0]] if parts[0] else []
    for run, word in zip(parts[1::2], parts[2::2]):
        if not word:
            out.append(run)
            continue
        if len(run) > 1:
            out.append(run[:-1])
        if run[-1] == " ":
            out.append(" " + word)
        else:
            out += [run[-1], word]
    return out


class Encoder:
    """The vocabulary of a tokenizer file: words to ids, and ids to pieces."""

    def __init__(self, path: str):
        raw = Path(path).read_bytes()
        spec = json.loads(raw)
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] \
                or spec["normalizer"] is not None:
            raise ValueError("only byte-level vocabularies without normalisation are supported")
        self.version = hashlib.sha256(raw).hexdigest()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        as_byte = {c: b for b, c in _byte_signs().items()}
        ranks = {
            bytes(as_byte[c] for c in piece): i
            for piece, i in spec["model"]["vocab"].items() if piece not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in pairs]
        if made != sorted(made):
            raise ValueError("ids must follow the order of the merges")
        self.pieces: list[bytes] = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        for sign, i in self.special.items():
            self.pieces[i] = sign.encode()
        # All pieces end to end, and where each begins.
        self.flat_pieces = (
            np.frombuffer(b"".join(self.pieces), np.uint8), np.cumsum([0, *map(len, self.pieces)]))
        self._bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._line = ranks[b"\n"]

    def words(self, text: str) -> list[str]:
        """Words and special strings of a text, in order."""
        if self._special is None or not any(s in text for s in self.special):
            return words(text)
        return [w for part in self._special.split(text)
                for w in ([part] if part in self.special else words(part))]

    def encode(self, distinct: Sequence[str]) -> list[np.ndarray]:
        """The ids of each word."""
        out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(distinct)
        plain = []
        for i, word in enumerate(distinct):
            if word in self.special:
                out[i] = np.array([self.special[word]], np.uint32)
            elif _EDGE.match(word[-1:]):
                out[i] = np.array(self._bpe.encode_ordinary(word), np.uint32)
            elif word:
                plain.append(i)
        # Words meet in one text, a line each: a line break is a token of its own there.
        for a in range(0, len(plain), 50_000):
            chosen = plain[a:a + 50_000]
            got = np.array(self._bpe.encode_ordinary("\n".join(distinct[i] for i in chosen)), np.uint32)
            cuts = np.flatnonzero(got == self._line)
            if len(cuts) != len(chosen) - 1:
                raise AssertionError("a word holds a line break")
            for i, ids in zip(chosen, np.split(got, cuts)):
                out[i] = ids if i == chosen[0] else ids[1:]
        return out


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The encoder of a file, once per worker process."""
    return Encoder(path)


def _byte_signs() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
