"""A byte-level vocabulary file, read once and encoded by the fastest library that gives the same ids.

Texts go through ``tiktoken`` with the file's own ranks, which gives the ids of the ``tokenizers`` library at a quarter of
its time. Only texts in which the two could part ways go through ``tokenizers`` itself: those that hold the string of a
special token, if such strings are to be tokens, and those with a run of characters so long that the time of a merge that
is quadratic in the run would count.
"""

import json
import re

import numpy as np

LONG_RUN = re.compile(r"\S{4000}|\s{4000}")


def byte_of_symbol() -> dict[str, int]:
    """The printable symbol that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand for
    themselves, all other bytes in their order for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Encoder of a vocabulary whose file was read on the driver. ``specials`` tells whether strings of special tokens
    that occur in a text are those tokens or plain text."""

    def __init__(self, spec: bytes, specials: bool):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        said = json.loads(spec)
        byte = byte_of_symbol()
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        names = {i: p for p, i in said["model"]["vocab"].items()}
        plain = {bytes(byte[c] for c in p): i for i, p in names.items() if p not in special}
        self.bytes_of = [b""] * (max([*names, *special.values()]) + 1)
        for p, i in plain.items():
            self.bytes_of[i] = p
        for p, i in special.items():
            self.bytes_of[i] = p.encode()
        self.lengths = np.array([len(p) for p in self.bytes_of], np.int64)
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=plain, special_tokens={})
        self.exact = Tokenizer.from_str(spec.decode())
        self.exact.encode_special_tokens = not specials
        self.marks = re.compile("|".join(map(re.escape, special))) if specials and special else None

    def encode(self, text: str) -> np.ndarray:
        if (self.marks and self.marks.search(text)) or (len(text) >= 4000 and LONG_RUN.search(text)):
            ids = self.exact.encode_batch_fast([text], add_special_tokens=False)[0].ids
            return np.array(ids, np.int64)
        return np.array(self.fast.encode_ordinary(text), np.int64)
