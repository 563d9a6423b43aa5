"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that its encoding ends with. A token
is that one if it is a suffix of the prefix and its neighbour, the last token of what is left, would
not have merged with it: then the two encodings side by side are the encoding of the whole. An
automaton over the vocabulary finds the suffixes of all prefixes in one pass, the pair test undoes
merges along the seam between two tokens, and following the stored last tokens backwards gives the
ids. The time is linear in the text, however long a piece is.

The prefixes of all new pieces of a batch are taken together, one byte further at a time, so each step is a few
array operations; only very long pieces are encoded on their own. Words repeat, so each worker keeps the ids of up
to `CACHE` of them and more only within a batch. A batch is cut into words at once, each is looked up for its
number, and the ids are gathered by arrays. The vocabulary file is read once by the driver and broadcast; its size
does not depend on the data.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from devicepulse.llm.common import sized, slices

# Fixed: how byte-level vocabularies cut a text into pieces before merging.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Fixed: what counts as white space in them.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# No piece crosses these bounds: a word takes the one space right before it, other white space stands alone.
WORDS = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
CACHE = 200_000  # words in a generation of a worker's cache
PAIRS = 1 << 20  # tested pairs that a worker keeps
LONG = 128  # bytes; longer pieces are encoded on their own
NONE = -1  # the last token of an empty prefix
BATCH_BYTES = 2 << 20


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, reversed."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def _gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of an array in a row."""
    through = np.cumsum(size)
    move = np.repeat(begin + size - through, size)
    return flat[np.arange(len(move)) + move]


class _Numbered:
    """Numbers of words, by which their ids are found in arrays.

    Between batches a full generation makes room for the next; what is looked up again is taken over from it.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], first: dict[str, int]):
        self.encode, self.first = encode, first
        self._begin()

    def _begin(self) -> None:
        self.number = {word: i for i, word in enumerate(self.first)}
        self.flat = np.fromiter(self.first.values(), np.int32, len(self.first))
        self.size = np.ones(len(self.first), np.int64)

    def _add(self, words: list[str], flat: np.ndarray, size: np.ndarray) -> None:
        self.number.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.flat, self.size = np.concatenate([self.flat, flat.astype(np.int32)]), np.concatenate([self.size, size])

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has."""
        older = None
        if len(self.number) > CACHE:
            older = self.number, self.flat, self.size
            self._begin()
        new = set(words).difference(self.number)
        if older:
            again = [w for w in new if w in older[0]]
            number = np.fromiter(map(older[0].__getitem__, again), np.int64, len(again))
            begin, size = np.cumsum(older[2]) - older[2], older[2][number]
            self._add(again, _gathered(older[1], begin[number], size), size)
            new.difference_update(again)
        if new:
            self._add(list(new), *self.encode(list(new)))
        number = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        size = self.size[number]
        return _gathered(self.flat, (np.cumsum(self.size) - self.size)[number], size), size


class TokenBytes:
    """The bytes of each token id, from the text of a tokenizer file: what decoding needs."""

    def __init__(self, spec: dict):
        letters = byte_letters()
        tokens = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items()}
        tokens |= {a["id"]: a["content"].encode() for a in spec.get("added_tokens", [])}
        self.known = np.zeros(max(tokens) + 1, bool)
        self.known[list(tokens)] = True
        ordered = [tokens.get(i, b"") for i in range(len(self.known))]
        self.size = np.fromiter(map(len, ordered), np.int64, len(ordered))
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(ordered), np.uint8)

    def join(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and where each id's end. Unknown ids raise."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.known) or not self.known[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        size = self.size[ids]
        ends = np.cumsum(size)
        move = np.repeat(self.begin[ids] - (ends - size), size)
        return self.data[np.arange(len(move)) + move], ends

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 become replacement characters."""
        return self.join(np.array(ids, np.int64))[0].tobytes().decode("utf-8", "replace")

    def texts(self, ids: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The texts of id lists that lie in a row, list i from starts[i] to starts[i + 1]."""
        data, ends = self.join(ids)
        at = np.concatenate([[0], ends])[starts]
        whole = data.tobytes()
        try:
            whole.decode()
            inner = at[:-1][at[:-1] < len(data)]
            valid = not (data[inner] & 0xC0 == 0x80).any()
        except UnicodeDecodeError:
            valid = False
        if valid:
            return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(whole))
        return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])], pa.string())


class Vocabulary:
    """A byte-level BPE vocabulary, from the text of a tokenizer file."""

    def __init__(self, spec: dict):
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        odd = model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or spec.get("normalizer")
        if odd or splitter.get("add_prefix_space") or not splitter.get("use_regex", True):
            raise ValueError("only byte-level BPE without a normalizer or a prefix space is supported")
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        ids = model["vocab"]
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = ids[left], ids[right]
            self.merged[pair] = rank, ids[left + right]
        for (left, right), (rank, whole) in self.merged.items():
            # A token made by several merges keeps the one that its own encoding takes.
            if whole not in self.parts and self._meet(left, right, rank):
                self.parts[whole] = rank, left, right
        automaton = ahocorasick.Automaton()
        letters = byte_letters()
        for token, i in ids.items():
            if len(token) == 1 or i in self.parts:
                raw = bytes(letters[c] for c in token)
                automaton.add_word(raw.decode("latin-1"), i)
        automaton.make_automaton()
        self.automaton = automaton
        self.special = {}
        for added in spec.get("added_tokens", []):
            if added["lstrip"] or added["rstrip"] or added["single_word"]:
                raise ValueError("added tokens that strip or need whole words are not supported")
            self.special[added["content"]] = added["id"]
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.numbered = _Numbered(self._encode_words, self.special)
        self._arrays(len(ids))

    def _arrays(self, n: int) -> None:
        """What is needed to test many pairs and follow many prefixes at once."""
        n = max(n, *(i + 1 for i in (*self.parts, *self.special.values(), *(j for p in self.merged for j in p), 0)))
        self.n = n
        pairs = np.array([a * n + b for a, b in self.merged], np.int64)
        order = np.argsort(pairs)
        ranks = np.array([rank for rank, _ in self.merged.values()], float)
        # One past the largest pair, so that a search always ends at an entry.
        self.pair_keys = np.append(pairs[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(ranks[order], np.inf)
        self.part_rank = np.full(n, -np.inf)
        self.part_left, self.part_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for token, (rank, left, right) in self.parts.items():
            self.part_rank[token], self.part_left[token], self.part_right[token] = rank, left, right
        self.token_size = np.zeros(n, np.int64)
        for word, token in self.automaton.items():
            self.token_size[token] = len(word)
        self.sizes = self.token_size.tolist()
        self.tested_keys, self.tested_good = np.array([np.iinfo(np.int64).max]), np.zeros(1, bool)

    def _meet(self, left: int, right: int, rank: float) -> bool:
        """Whether the seam between two tokens stays open until merges of `rank`.

        The tokens are taken apart in the reverse of the order they were merged in, the later merge
        first, and of two equal ones the right one first, as merging goes from left to right. The seam
        stays open if at no time the two tokens beside it had a merge that came before.
        """
        last = rank
        while True:
            crossing = self.merged.get((left, right))
            if crossing is not None and crossing[0] < last:
                return False
            a, b = self.parts.get(left), self.parts.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                last, left = a[0], a[2]
            else:
                # The crossing pair lies left of the right token's merge and goes first if equal.
                last, right = b[0] + 0.5, b[1]

    def _all_meet(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`_meet` of many pairs from the end on."""
        good = np.ones(len(left), bool)
        last = np.full(len(left), np.inf)
        open_ = np.arange(len(left))
        left, right = left.copy(), right.copy()
        while len(open_):
            key = left * self.n + right
            at = np.searchsorted(self.pair_keys, key)
            crossed = (self.pair_keys[at] == key) & (self.pair_ranks[at] < last)
            good[open_[crossed]] = False
            a, b = self.part_rank[left], self.part_rank[right]
            more = ~crossed & (np.maximum(a, b) > -np.inf)
            by_left = (a > b)[more]
            open_, left, right, a, b = open_[more], left[more], right[more], a[more], b[more]
            last = np.where(by_left, a, b + 0.5)
            left = np.where(by_left, self.part_right[left], left)
            right = np.where(by_left, right, self.part_left[right])
        return good

    def _all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether two tokens side by side are the encoding of their bytes."""
        key = left * self.n + right
        at = np.searchsorted(self.tested_keys, key)
        known = self.tested_keys[at] == key
        good = self.tested_good[at]
        if not known.all():
            new, place = np.unique(key[~known], return_inverse=True)
            made = self._all_meet(new // self.n, new % self.n)
            good[~known] = made[place]
            where = np.searchsorted(self.tested_keys, new)
            self.tested_keys = np.insert(self.tested_keys, where, new)
            self.tested_good = np.insert(self.tested_good, where, made)
        return good

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of short pieces in a row, and how many each has: one byte of all pieces after the other."""
        if len(self.tested_keys) > PAIRS:
            self.tested_keys, self.tested_good = self.tested_keys[-1:], self.tested_good[-1:]
        # A sign that is no byte keeps the pieces apart.
        text = "\u0100".join([p.decode("latin-1") for p in pieces])
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(sizes + 1) - sizes - 1
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int32).reshape(-1, 2)
        end, token = found[:, 0].astype(np.int64) + 1, found[:, 1].astype(np.int64)
        before = end - self.token_size[token]
        start = np.repeat(starts, sizes + 1)[end - 1] if len(end) else end
        step = end - start
        order = np.argsort(step, kind="stable")
        end, token, before, first = end[order], token[order], before[order], (before == start)[order]
        bounds = np.searchsorted(step[order], np.arange(1, int(sizes.max(initial=0)) + 2))
        # The last token of each prefix, by where it ends; a piece's empty prefix has none.
        last = np.full(len(text) + 1, NONE, np.int64)
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            good = first[lo:hi].copy()
            rest = np.flatnonzero(~good)
            good[rest] = self._all_compatible(last[before[lo:hi][rest]], token[lo:hi][rest])
            last[end[lo:hi][good]] = token[lo:hi][good]
        # Back from the ends, a token of every piece at a time.
        at, which, taken = starts + sizes, np.arange(len(pieces)), []
        while True:
            left = at > starts[which]
            at, which = at[left], which[left]
            if not len(at):
                break
            taken.append((which, last[at]))
            at = at - self.token_size[last[at]]
        if not taken:
            return np.zeros(0, np.int64), np.zeros(len(pieces), np.int64)
        owner, ids = (np.concatenate(x[::-1]) for x in zip(*taken, strict=True))
        order = np.argsort(owner, kind="stable")
        return ids[order], np.bincount(owner, minlength=len(pieces))

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new words in a row, and how many each has."""
        cut = [PIECES.findall(word) for word in words]
        number: dict[str, int] = {}
        for piece in chain.from_iterable(cut):
            number.setdefault(piece, len(number))
        raw = [piece.encode() for piece in number]
        short = [i for i, p in enumerate(raw) if len(p) <= LONG]
        flat, size = self.encode_pieces([raw[i] for i in short])
        sizes = np.zeros(len(raw), np.int64)
        sizes[short] = size
        begin = np.zeros(len(raw), np.int64)
        begin[short] = np.cumsum(size) - size
        for i, p in enumerate(raw):
            if len(p) > LONG:
                ids = np.array(self.encode_piece(p), np.int64)
                begin[i], sizes[i] = len(flat), len(ids)
                flat = np.concatenate([flat, ids])
        pieces = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64)
        ids = _gathered(flat, begin[pieces], sizes[pieces])
        through = np.concatenate([[0], np.cumsum(sizes[pieces])])
        ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        return ids, np.diff(through[ends], prepend=0)

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one piece of any length."""
        # Each prefix ends with one token; before the first byte there is none.
        last = [NONE] * (len(piece) + 1)
        sizes, tested = self.sizes, {}
        for end, token in self.automaton.iter(piece.decode("latin-1")):
            end += 1
            if last[end] == NONE:
                size = sizes[token]
                if size == end:
                    last[end] = token
                    continue
                pair = last[end - size], token
                if pair not in tested:
                    tested[pair] = self._meet(*pair, float("inf"))
                if tested[pair]:
                    last[end] = token
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= sizes[last[at]]
        return ids[::-1]

    def _words(self, text: str) -> list[str]:
        """Words and runs of white space of a text, special tokens apart."""
        if self.cut is None or not any(t in text for t in self.special):
            return WORDS.findall(text)
        words: list[str] = []
        for part in self.cut.split(text):
            words += [part] if part in self.special else WORDS.findall(part)
        return words

    def encode_all(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin and the last one's end."""
        words: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                words += self._words(text)
            ends.append(len(words))
        ids, size = self.numbered.ids(words)
        return ids, np.concatenate([[0], np.cumsum(size)])[ends]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()


_LOADED: dict[tuple[type, int], object] = {}


def _loaded(kind: type, shared):
    """One of each kind per worker process."""
    if (kind, shared.id) not in _LOADED:
        # A worker may encode and decode by turns: only those of another vocabulary go.
        for other in [k for k in _LOADED if k[1] != shared.id]:
            del _LOADED[other]
        _LOADED[kind, shared.id] = kind(json.loads(shared.value))
    return _LOADED[kind, shared.id]


class _Shared:
    """A broadcast with its number, which survives pickling."""

    def __init__(self, spark, content: str):
        self.broadcast = spark.sparkContext.broadcast(content)
        self.id = hash(content)

    @property
    def value(self) -> str:
        return self.broadcast.value


def load(df: DataFrame, path: str) -> _Shared:
    """Read a vocabulary file on the driver, for several calls over one session."""
    with open(path, encoding="utf-8") as f:
        content = f.read()
    Vocabulary(json.loads(content))  # an unsupported file fails here, not in a task
    return _Shared(df.sparkSession, content)


def _with(df: DataFrame, source: str, **made: T.DataType) -> tuple[DataFrame, T.StructType]:
    """`df` with the source column first, and the schema of its other columns plus the made ones."""
    keep = [c for c in df.columns if c not in made and c != source]
    first = df.select(f"`{source}`", *[f"`{c}`" for c in keep])
    fields = [f for f in first.schema.fields if f.name != source]
    return first, T.StructType(fields + [T.StructField(n, t) for n, t in made.items()])


def encode(
    df: DataFrame, vocabulary: _Shared, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Replace the text column by the array of its token ids.

    A null or empty text has no ids. Whole texts of any length are encoded; texts go through a task a
    few megabytes at a time. Rows are kept as they are, repeated ones too; a column that is already
    named `ids` is replaced. With `decoded`, that column gets the text that `decode` makes of the ids, in the
    same pass: one worker for each task holds the vocabulary then, not two.
    """
    made_types = {ids: T.ArrayType(T.IntegerType(), False)} | ({decoded: T.StringType()} if decoded else {})
    first, schema = _with(df, text, **made_types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(Vocabulary, vocabulary)
        back = _loaded(TokenBytes, vocabulary) if decoded else None
        for batch in sized(batches, 0, BATCH_BYTES):
            flat, ends = coder.encode_all(batch.column(0).to_pylist())
            made = [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))]
            if back:
                made.append(back.texts(flat, ends))
            rest = [(batch.schema.field(i).name, batch.column(i)) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), *made], [*(n for n, _ in rest), *made_types])

    return first.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: _Shared, ids: str = "ids", text: str = "text") -> DataFrame:
    """Replace the array of token ids by its text. Null or no ids give an empty text."""
    first, schema = _with(df, ids, **{text: T.StringType()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _loaded(TokenBytes, vocabulary)
        for batch in slices(batches, 512):
            lists = batch.column(0).fill_null([])
            starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            made = coder.texts(lists.flatten().to_numpy(), starts)
            rest = [(batch.schema.field(i).name, batch.column(i)) for i in range(1, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), made], [*(n for n, _ in rest), text])

    return first.mapInArrow(run, schema)
