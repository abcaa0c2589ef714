"""Ids of byte-level tokenizers, for texts of any length.

The pattern matches white space greedily but leaves its last character to the word that follows,
and it never looks back. A match therefore starts at every space that has no white space before it
or none behind it. Long texts are cut at such spaces, and a part without any goes to the tokenizer
itself, which needs no stack for a long run of one class of characters.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

# Fixed value: the pattern of byte-level tokenizers.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Characters encoded at once.
WHOLE = 50_000

_cut = re.compile(r"(?<=\S) | (?=\S)")


def parts_of(text: str, size: int = WHOLE) -> list[str]:
    """`text` in parts of at most `size` characters that start at spaces no match crosses; a part
    is longer where there is no such space."""
    if len(text) <= size:
        return [text]
    parts, begin, last = [], 0, 0
    for found in _cut.finditer(text):
        at = found.start()
        if at - begin > size and last > begin:
            parts.append(text[begin:last])
            begin = last
        last = at
    if len(text) - begin > size and last > begin:
        parts.append(text[begin:last])
        begin = last
    return [*parts, text[begin:]]


def printable_bytes() -> dict[str, int]:
    """The character a byte-level vocabulary writes for each byte: printable Latin-1 ones stand for
    themselves, the others for code points from 256 on, in order."""
    found, others = {}, 256
    for byte in range(256):
        plain = 33 <= byte <= 126 or 161 <= byte <= 172 or 174 <= byte <= 255
        found[chr(byte) if plain else chr(others)] = byte
        others += not plain
    return found


class ByteLevelIds:
    """A byte-level tokenizer with the pattern above, from its JSON.

    Strings of special tokens inside texts become those tokens unless `plain`. Parts go through
    the same vocabulary as ranks, which is faster, where its merges are in the order of ids.
    """

    def __init__(self, file: bytes, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are for Spark's tasks
        self.tokenizer = Tokenizer.from_buffer(file)
        self.tokenizer.encode_special_tokens = plain
        level = self.tokenizer.pre_tokenizer
        if not isinstance(level, ByteLevel) or level.add_prefix_space or not level.use_regex:
            raise ValueError("a byte-level tokenizer without prefix space is needed")
        spec = json.loads(file)["model"]
        added = {n: token.content for n, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {} if plain else {text: number for number, text in added.items()}
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        table = printable_bytes()
        self.token_bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, number in spec["vocab"].items():
            self.token_bytes[number] = (
                token.encode() if number in added else bytes(table[c] for c in token)
            )
        merged = [
            spec["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["merges"]
        ]
        self.ranks = None
        if all(a < b for a, b in zip(merged, merged[1:])):
            self.ranks = tiktoken.Encoding(
                "given", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                    b: n for n, b in enumerate(self.token_bytes) if b and n not in added
                },
            )

    def _part(self, text: str) -> np.ndarray:
        if self.ranks is None or len(text) > WHOLE:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.asarray(found, np.uint32)
        return np.asarray(self.ranks.encode_ordinary(text), np.uint32)

    def ids(self, text: str) -> np.ndarray:
        """The ids of a text, as the tokenizer gives them without added tokens."""
        if any(name in text for name in self.special):
            pieces = [
                np.array([self.special[x]], np.uint32) if x in self.special else self.ids(x)
                for x in self._special.split(text) if x
            ]
        else:
            pieces = [self._part(part) for part in parts_of(text)]
        return pieces[0] if len(pieces) == 1 else np.concatenate(pieces)
