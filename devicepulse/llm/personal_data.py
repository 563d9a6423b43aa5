"""Personal data: fixed patterns, and a character model for what they miss.

The patterns find emails, IP addresses, cards and phone numbers. A bidirectional LSTM over characters with
a CRF over its tags, trained in numpy on labelled spans, finds secrets and written-out forms as well.
It reads overlapping windows around everything that could be part of such data; the scores that windows
give to the same character are added up, and one best tag path is taken over all of a stretch, so spans
that cross windows come out whole. Found spans are added where they touch none of the patterns'.

Weights are a few kilobytes, fitted on the driver to spans made by a seeded generator, and broadcast.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from devicepulse.llm.common import sized

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
BATCH_BYTES = 4 << 20
Span = tuple[str, int, int]

# --- patterns -------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# Beginning within a run of digits can only fail as beginning before it did.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @, domain. Each @ is looked at once, from where its local part begins."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def valid(kind: str, found: str) -> bool:
    """What a match must hold beyond its pattern."""
    if kind == "ip":
        parts = found.split(".")
        return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
    if kind == "card":
        digits = _digits(found)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(found)) <= 15
    return True


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by start and kind, in code points. A match that fails its check is dropped
    and nothing within it is tried."""
    found: list[Span] = [("email", *e) for e in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
            found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the model ------------------------------------------------------------------------------------

WINDOW, STRIDE, REACH = 64, 32, 40
TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
_PAD, _OTHER, _LETTER = 0, 1, 2
_N_CHARS = 98
_BARRED = -1e4


def char_ids(text: str) -> np.ndarray:
    """ASCII characters as they are, other letters as one, everything else as another."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    ids = np.where((points >= 32) & (points < 127), points - 32 + 3, np.where(points > 0xBF, _LETTER, _OTHER))
    return ids.astype(np.int16)


@dataclass(frozen=True)
class Training:
    examples: int = 3000
    steps: int = 260
    batch: int = 48
    embed: int = 12
    hidden: int = 20
    rate: float = 0.02
    seed: int = 11


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, a large penalty where not: I-x only after B-x or I-x."""
    barred = np.zeros((len(TAGS), len(TAGS)))
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            for i, before in enumerate(TAGS):
                if before[2:] != tag[2:] or before == "O":
                    barred[i, j] = _BARRED
    return barred


ALLOWED = _allowed()
START = np.array([_BARRED if t[0] == "I" else 0.0 for t in TAGS])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Tagger:
    """Two LSTMs over character embeddings, one from each side, a linear layer, and tag transitions."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def new(cls, t: Training) -> Tagger:
        rng, h = np.random.default_rng(t.seed), t.hidden
        w = {"embed": rng.normal(0, 0.3, (_N_CHARS, t.embed))}
        for side in "fb":
            w[f"in_{side}"] = rng.normal(0, t.embed**-0.5, (t.embed, 4 * h))
            w[f"rec_{side}"] = rng.normal(0, h**-0.5, (h, 4 * h))
            w[f"bias_{side}"] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)])
        w["out"] = rng.normal(0, h**-0.5, (2 * h, len(TAGS)))
        w["out_bias"] = np.zeros(len(TAGS))
        w["moves"] = np.zeros((len(TAGS), len(TAGS)))
        return cls(w)

    def _side(self, x: np.ndarray, side: str):
        """Hidden states (T, B, H) of one direction and what its gradient needs. x: (T, B) characters."""
        gates_of = self.w["embed"] @ self.w[f"in_{side}"] + self.w[f"bias_{side}"]
        rec = self.w[f"rec_{side}"]
        n = rec.shape[0]
        h = c = np.zeros((x.shape[1], n))
        states, kept = [], []
        for row in x:
            g = gates_of[row] + h @ rec
            s = _sigmoid(g[:, : 3 * n])
            i, f, o, u = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :], np.tanh(g[:, 3 * n :])
            before = h, c
            c = f * c + i * u
            tc = np.tanh(c)
            h = o * tc
            states.append(h)
            kept.append((i, f, o, u, tc, *before))
        return np.stack(states), kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(T, B, tags) scores of (T, B) characters."""
        forward, _ = self._side(x, "f")
        backward, _ = self._side(x[::-1], "b")
        return np.concatenate([forward, backward[::-1]], 2) @ self.w["out"] + self.w["out_bias"]

    def moves(self) -> np.ndarray:
        return self.w["moves"] + ALLOWED

    def loss(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of (T, B) tags, and its gradient."""
        w, (steps, n) = self.w, x.shape
        forward, kept_f = self._side(x, "f")
        backward, kept_b = self._side(x[::-1], "b")
        both = np.concatenate([forward, backward[::-1]], 2)
        scores = both @ w["out"] + w["out_bias"]
        moves, at = self.moves(), np.arange(n)
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[0] = START + scores[0]
        for t in range(1, steps):
            alpha[t] = _logsum(alpha[t - 1][:, :, None] + moves, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        log_z = _logsum(alpha[-1], 1)
        gold = (START[tags[0]] + scores[0, at, tags[0]]).sum()
        d_scores, d_moves = np.exp(alpha + beta - log_z[:, None]), np.zeros_like(moves)
        for t in range(steps):
            if t:
                gold += (moves[tags[t - 1], tags[t]] + scores[t, at, tags[t]]).sum()
                pair = alpha[t - 1][:, :, None] + moves + (scores[t] + beta[t])[:, None, :] - log_z[:, None, None]
                d_moves += np.exp(pair).sum(0)
                np.add.at(d_moves, (tags[t - 1], tags[t]), -1)
            d_scores[t, at, tags[t]] -= 1
        grad = {"moves": d_moves, "out": np.einsum("tbh,tbk->hk", both, d_scores), "out_bias": d_scores.sum((0, 1))}
        d_both = d_scores @ w["out"].T
        h = forward.shape[2]
        grad["embed"] = np.zeros_like(w["embed"])
        self._back(x, d_both[:, :, :h], kept_f, "f", grad)
        self._back(x[::-1], d_both[::-1, :, h:], kept_b, "b", grad)
        return float(log_z.sum() - gold) / n, {k: g / n for k, g in grad.items()}

    def _back(self, x, d_states, kept, side, grad) -> None:
        rec, into = self.w[f"rec_{side}"], self.w[f"in_{side}"]
        d_rec, d_gates = np.zeros_like(rec), np.zeros((_N_CHARS, rec.shape[1]))
        d_h = d_c = 0.0
        for t in range(len(x) - 1, -1, -1):
            i, f, o, u, tc, h_before, c_before = kept[t]
            d_h = d_h + d_states[t]
            d_c = d_c + d_h * o * (1 - tc**2)
            parts = (d_c * u * i * (1 - i), d_c * c_before * f * (1 - f), d_h * tc * o * (1 - o), d_c * i * (1 - u**2))
            g = np.concatenate(parts, 1)
            d_rec += h_before.T @ g
            np.add.at(d_gates, x[t], g)
            d_h, d_c = g @ rec.T, d_c * f
        grad[f"rec_{side}"], grad[f"bias_{side}"] = d_rec, d_gates.sum(0)
        grad[f"in_{side}"] = self.w["embed"].T @ d_gates
        grad["embed"] += d_gates @ into.T

    def best_paths(self, scores: np.ndarray) -> np.ndarray:
        """The best tags (T, B) for scores (T, B, tags)."""
        moves, back = self.moves(), []
        best = START + scores[0]
        for row in scores[1:]:
            through = best[:, :, None] + moves
            back.append(through.argmax(1))
            best = through.max(1) + row
        path = [best.argmax(1)]
        for step in reversed(back):
            path.append(step[np.arange(len(path[-1])), path[-1]])
        return np.stack(path[::-1])

    def best_path(self, blocks: Iterator[np.ndarray]) -> np.ndarray:
        """The best tags (T) for scores (T, tags) that come in blocks; a byte per character and tag is held."""
        moves, back, best = self.moves(), [], None
        for block in blocks:
            steps = np.zeros(block.shape, np.int8)
            for t, row in enumerate(block):
                if best is None:
                    best = START + row
                    continue
                through = best[:, None] + moves
                steps[t] = through.argmax(0)
                best = through.max(0) + row
            back.append(steps)
        tag, path = int(best.argmax()), []
        for steps in reversed(back):
            part = np.empty(len(steps), np.int8)
            for t in range(len(steps) - 1, -1, -1):
                part[t] = tag
                tag = steps[t, tag]
            path.append(part)
        return np.concatenate(path[::-1])


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis))


# --- labelled spans ---------------------------------------------------------------------------------


def _word(rnd: random.Random) -> str:
    return "".join(rnd.choice(("th", "er", "on", "an", "re", "in", "de", "la", "ch", "ou", "é", "ü", "st", "e", "a")) for _ in range(rnd.randint(1, 4)))


def _run(rnd: random.Random, letters: str, n: int) -> str:
    return "".join(rnd.choice(letters) for _ in range(n))


def _example(rnd: random.Random, kind: str) -> tuple[str, str]:
    """(before, data) of a kind."""
    digits, hexes = "0123456789", "0123456789abcdef"
    name, host = f"{_word(rnd)}.{rnd.randint(1, 99)}", f"{_word(rnd)}{rnd.randint(1, 9)}"
    if kind == "email":
        at, dot = rnd.choice([("@", "."), (" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]")])
        return "", f"{name}{at}{host}{dot}{rnd.choice(['com', 'example', 'org'])}"
    if kind == "ip":
        return "", ".".join(str(rnd.randint(0, 255)) for _ in range(4))
    if kind == "card":
        body = _run(rnd, digits, 15)
        number = body + next(c for c in digits if luhn(body + c))
        return "", rnd.choice([number, " ".join(number[i : i + 4] for i in range(0, 16, 4))])
    if kind == "phone":
        head = rnd.choice(["+1 ", "+44 ", "", "+"])
        return "", f"{head}({_run(rnd, digits, 3)}) {_run(rnd, digits, 3)}-{_run(rnd, digits, 4)}"
    before = rnd.choice(['token = "', 'key: "', "secret=", 'password = "', 'api_key="'])
    return before, rnd.choice([_run(rnd, hexes, 40), _run(rnd, hexes, 32), _run(rnd, hexes + "ghijklmnopqrstuvwxyzABCDEFGH", 24)])


def _decoy(rnd: random.Random) -> str:
    """Digits and signs that are no personal data."""
    n = rnd.randrange(6)
    if n == 0:
        return f"{rnd.randint(1, 9)}.{rnd.randint(0, 9)}"
    if n == 1:
        return str(rnd.randint(1, 10 ** rnd.randint(1, 7)))
    if n == 2:
        return f"{rnd.randint(1900, 2030)}-{rnd.randint(1, 12)}-{rnd.randint(1, 28)}"
    if n == 3:
        body = _run(rnd, "0123456789", 15)
        return body + next(c for c in "0123456789" if not luhn(body + c))
    return rnd.choice([f"BY-NC {rnd.randint(1, 4)}.0", f"@{_word(rnd)}", f"{_word(rnd)}{rnd.randint(0, 99)}", "a@ b"])


def labelled_windows(t: Training) -> tuple[np.ndarray, np.ndarray]:
    """(T, N) characters and tags of windows cut from made texts."""
    rnd = random.Random(t.seed)
    chars, tags = [], []
    for _ in range(t.examples):
        text, spans = "", []
        while len(text) < 3 * WINDOW:
            text += " ".join(_word(rnd) for _ in range(rnd.randint(1, 9))) + rnd.choice([" ", " ", ". ", "\n"])
            if rnd.random() < 0.35:
                text += _decoy(rnd) + rnd.choice([" ", ". "])
            elif rnd.random() < 0.75:
                kind = rnd.choice(KINDS)
                before, data = _example(rnd, kind)
                spans.append((kind, len(text) + len(before), len(text) + len(before) + len(data)))
                text += before + data + ('"' if before.endswith('"') else "") + rnd.choice([" ", ". ", ", "])
        at = rnd.randrange(len(text) - WINDOW)
        row = np.zeros(len(text), np.int64)
        for kind, a, b in spans:
            row[a:b] = TAGS.index(f"I-{kind}")
            row[a] -= 1
        cut = row[at : at + WINDOW]
        # A window may begin within a span: its first character then begins it.
        if cut[0] and TAGS[cut[0]][0] == "I":
            cut = cut.copy()
            cut[0] -= 1
        chars.append(char_ids(text)[at : at + WINDOW])
        tags.append(cut)
    return np.stack(chars, 1).astype(np.int64), np.stack(tags, 1)


@lru_cache(maxsize=4)
def train(t: Training = Training()) -> Tagger:
    """Fit by Adam on the labelled windows. The same parameters give the same weights."""
    chars, tags = labelled_windows(t)
    model, rng = Tagger.new(t), np.random.default_rng(t.seed)
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    for step in range(1, t.steps + 1):
        rows = rng.integers(0, chars.shape[1], t.batch)
        _, grad = model.loss(chars[:, rows], tags[:, rows])
        size = max(1.0, np.sqrt(sum(float((g**2).sum()) for g in grad.values())) / 5)
        rate = t.rate * min(1, 2 - 2 * step / t.steps)
        for k, g in grad.items():
            first[k] = 0.9 * first[k] + 0.1 * g / size
            second[k] = 0.99 * second[k] + 0.01 * (g / size) ** 2
            unbiased = first[k] / (1 - 0.9**step), second[k] / (1 - 0.99**step)
            model.w[k] = model.w[k] - rate * unbiased[0] / (np.sqrt(unbiased[1]) + 1e-8)
    return model


# --- windows over texts -----------------------------------------------------------------------------

# What any kind of data has in it; the model reads everything near it.
_SEED = re.compile(r"[0-9@]|[\[( ]at[\]) ][^\n]{1,40}?[\[( ]dot[\]) ]")


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text within reach of a seed, apart from each other."""
    found: list[list[int]] = []
    for m in _SEED.finditer(text):
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if found and a <= found[-1][1]:
            found[-1][1] = max(b, found[-1][1])
        else:
            found.append([a, b])
    return [(a, b) for a, b in found]


def model_spans(texts: list[str], model: Tagger, most_windows: int = 2048) -> list[list[Span]]:
    """Spans of the model in each text, before they are held against the patterns.

    Stretches of like length are read together. A stretch longer than `most_windows` windows is read by so
    many at a time, and decoded as one.
    """
    jobs = []
    out: list[list[Span]] = [[] for _ in texts]
    for i, text in enumerate(texts):
        for a, b in stretches(text):
            if b - a > most_windows * STRIDE + STRIDE:
                path = model.best_path(_score_blocks(char_ids(text[a:b]), model, most_windows))
                out[i] += _tagged(path, a)
            else:
                jobs.append((i, a, b))
    jobs.sort(key=lambda j: j[2] - j[1])
    held, windows = [], 0
    for job in jobs:
        n = max(1, -(-(job[2] - job[1] - WINDOW) // STRIDE) + 1)
        if held and windows + n > most_windows:
            _read(held, texts, model, out)
            held, windows = [], 0
        held.append(job)
        windows += n
    if held:
        _read(held, texts, model, out)
    return out


# The middle of a window has context on both sides and counts most.
_TRUST = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(float)


def _read(jobs, texts, model: Tagger, out) -> None:
    rows, place = [], []
    for k, (i, a, b) in enumerate(jobs):
        ids = char_ids(texts[i][a:b])
        for at in range(0, max(1, len(ids) - WINDOW + STRIDE), STRIDE):
            row = np.zeros(WINDOW, np.int64)
            cut = ids[at : at + WINDOW]
            row[: len(cut)] = cut
            rows.append(row)
            place.append((k, at, len(cut)))
    longest = max(b - a for _, a, b in jobs)
    total = np.zeros((longest, len(jobs), len(TAGS)))
    weight = np.zeros((longest, len(jobs)))
    scores = model.emissions(np.stack(rows, 1))
    for w, (k, at, n) in enumerate(place):
        total[at : at + n, k] += scores[:n, w] * _TRUST[:n, None]
        weight[at : at + n, k] += _TRUST[:n]
    total /= np.maximum(weight, 1e-9)[:, :, None]
    total[weight == 0, 1:] = _BARRED
    paths = model.best_paths(total)
    for k, (i, a, b) in enumerate(jobs):
        out[i] += _tagged(paths[: b - a, k], a)


def _score_blocks(ids: np.ndarray, model: Tagger, most_windows: int) -> Iterator[np.ndarray]:
    """The scores of a stretch, block by block; characters that the next windows read too are held back."""
    starts = range(0, max(1, len(ids) - WINDOW + STRIDE), STRIDE)
    total, weight, begin = np.zeros((0, len(TAGS))), np.zeros(0), 0
    for k in range(0, len(starts), most_windows):
        some = starts[k : k + most_windows]
        rows = np.zeros((WINDOW, len(some)), np.int64)
        for w, at in enumerate(some):
            cut = ids[at : at + WINDOW]
            rows[: len(cut), w] = cut
        scores = model.emissions(rows)
        more = min(len(ids), some[-1] + WINDOW) - begin - len(total)
        total, weight = np.concatenate([total, np.zeros((more, len(TAGS)))]), np.concatenate([weight, np.zeros(more)])
        for w, at in enumerate(some):
            n = min(WINDOW, len(ids) - at)
            total[at - begin : at - begin + n] += scores[:n, w] * _TRUST[:n, None]
            weight[at - begin : at - begin + n] += _TRUST[:n]
        done = len(total) if some[-1] == starts[-1] else some[-1] + STRIDE - begin
        yield total[:done] / weight[:done, None]
        total, weight, begin = total[done:], weight[done:], begin + done


def _tagged(tags: np.ndarray, begin: int) -> list[Span]:
    """The spans that a path of tags marks."""
    found, t = [], 0
    while t < len(tags):
        if tags[t] and TAGS[tags[t]][0] == "B":
            end = t + 1
            while end < len(tags) and tags[end] == tags[t] + 1:
                end += 1
            found.append((TAGS[tags[t]][2:], begin + t, begin + end))
            t = end
        else:
            t += 1
    return found


_SECRET = re.compile(r"[A-Za-z0-9_\-]{16,}")


def _plausible(kind: str, found: str) -> bool:
    if kind == "email":
        return bool(re.fullmatch(r"\S+ ?[\[(]?(?:@|\bat\b)[\])]? ?\S+(?: ?[\[(]?(?:\.|\bdot\b)[\])]? ?\S+)+", found))
    if kind == "secret":
        return bool(_SECRET.fullmatch(found)) and bool(_DIGIT.search(found)) and bool(re.search("[A-Za-z]", found))
    return valid(kind, found)


def find(texts: list[str], model: Tagger) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text. A span of the model is added if it passes the checks of its kind,
    and overlaps no base span and none added before it."""
    found = []
    for text, more in zip(texts, model_spans(texts, model), strict=True):
        base = base_spans(text)
        taken = [(a, b) for _, a, b in base]
        spans = list(base)
        for kind, a, b in in_order(more):
            apart = all(b <= x or y <= a for x, y in taken)
            if apart and _plausible(kind, text[a:b]):
                spans.append((kind, a, b))
                taken.append((a, b))
        found.append((base, in_order(spans)))
    return found


def _batches(df: DataFrame, text: str, add, fields: list[T.StructField], training: Training) -> DataFrame:
    """Run `add(texts, found)` over batches; its arrays follow the columns of df, the text's own last of them."""
    shared = df.sparkSession.sparkContext.broadcast(train(training).w)
    keep = [c for c in df.columns if c != text and c not in {f.name for f in fields}]
    first = df.select(f"`{text}`", *[f"`{c}`" for c in keep])
    schema = T.StructType([f for f in first.schema.fields if f.name != text] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Tagger(shared.value)
        for batch in sized(batches, 0, BATCH_BYTES):
            texts = batch.column(0).to_pylist()
            found = find([t or "" for t in texts], model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *add(texts, found)], [*batch.schema.names[1:], *(f.name for f in fields)]
            )

    return first.mapInArrow(run, schema)


def detect(df: DataFrame, text: str = "text", training: Training = Training()) -> DataFrame:
    """Replace the text by n_email, n_ip, n_card, n_phone (spans of the patterns), base_spans and spans, as
    kind:start:end joined by commas, in code points.

    A null or empty text has no spans. The patterns read every row whole and on its own; the model reads the
    stretches of 40 characters around digits, `@` and written-out `at … dot`, without which it reports nothing.
    Columns of the added names are replaced.
    """

    def add(texts, found):
        counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE_KINDS]
        return [
            *counts,
            pa.array([written(base) for base, _ in found], pa.string()),
            pa.array([written(spans) for _, spans in found], pa.string()),
        ]

    fields = [T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS]
    fields += [T.StructField("base_spans", T.StringType()), T.StructField("spans", T.StringType())]
    return _batches(df, text, add, fields, training)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans, their union by
    the first."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(df: DataFrame, text: str = "text", training: Training = Training()) -> DataFrame:
    """The same rows and columns with personal data masked. Null texts stay null."""

    def add(texts, found):
        return [pa.array([t and masked(t, spans) for t, (_, spans) in zip(texts, found, strict=True)], pa.string())]

    changed = _batches(df, text, add, [T.StructField(text, T.StringType())], training)
    return changed.select(*[F.col(f"`{c}`") for c in df.columns])
