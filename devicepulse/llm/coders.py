"""Public tokenizers by their libraries, loaded once per worker process from what the driver read.

The vocabulary files are read on the driver and broadcast, so that executors need no copy of their own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import SparkSession

# Fixed: how byte-level vocabularies cut a text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict[str, object] = {}


class Coder:
    """A vocabulary file for the tasks of a session; `load` makes the coder of this process."""

    def __init__(self, spark: SparkSession, path: str, make: Callable[[bytes], object]):
        with open(path, "rb") as f:
            content = f.read()
        self.key = f"{make.__name__}:{hashlib.sha256(content).hexdigest()}"
        self.make = make
        self.shared = spark.sparkContext.broadcast(content)
        _LOADED[self.key] = make(content)  # an unsupported file fails here, not in a task

    def __getstate__(self):
        return {"key": self.key, "make": self.make, "shared": self.shared}

    def load(self):
        if self.key not in _LOADED:
            _LOADED[self.key] = self.make(self.shared.value)
        return _LOADED[self.key]


def _byte_signs() -> dict[str, int]:
    """The printable sign that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bytes:
    """The bytes of each token of a vocabulary, in one array."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.names = [str(i) for i in range(len(tokens))]

    def __len__(self) -> int:
        return len(self.sizes)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.starts[ids] - (ends - sizes), sizes)]


class ByteLevel:
    """A byte-level BPE vocabulary whose merges come in the order of its ids."""

    def __init__(self, content: bytes):
        import tiktoken

        file = json.loads(content)
        model, signs = file["model"], _byte_signs()
        ranks = {bytes(signs[c] for c in t): i for t, i in model["vocab"].items() if all(c in signs for c in t)}
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        ranks = {t: i for t, i in ranks.items() if i not in special.values()}
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        made = [model["vocab"][m] for m in merged]
        if made != sorted(made) or model.get("unk_token") or file.get("normalizer") or len(ranks) != 256 + len(made):
            raise ValueError("not a byte-level vocabulary with ids in the order of its merges")
        self.coder = tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)
        by_id = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.bytes = Bytes([by_id.get(i, b"") for i in range(max(by_id) + 1)])

    def ids(self, text: str, special: bool) -> np.ndarray:
        """Token ids; strings of special tokens count as such or as plain text."""
        if special:
            return self.coder.encode_to_numpy(text, allowed_special="all")
        return self.coder.encode_to_numpy(text, disallowed_special=())


class Pieces:
    """A piece vocabulary with byte fallback."""

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor

        self.coder = SentencePieceProcessor(model_proto=content)
        size = self.coder.get_piece_size()
        self.bytes = Bytes([self._bytes(i) for i in range(size)])

    def _bytes(self, i: int) -> bytes:
        piece = self.coder.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.coder.is_byte(i) else piece.replace("▁", " ").encode()

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)
