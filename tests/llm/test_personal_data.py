"""Patterns against the plain regular expressions, gradients against differences, spans across windows."""

import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from devicepulse.llm import personal_data as p

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    found = [
        (kind, m.start(), m.end())
        for kind, pattern in PLAIN.items()
        for m in pattern.finditer(text)
        if p.valid(kind, m.group())
    ]
    return p.in_order(found)


PARTS = ["a", "b.c", "@", ".", "x@y.z", "1", "12", "255.", "256", "4111 1111 1111 1111", "4111111111111111", "-", " ", "+"]
PARTS += ["+1 (017) 555-7713", "10.0.0.1", "(", ")", "é", "٣", "00", "@@", "a@b", ".com", "\n", "+4"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_patterns(text):
    assert p.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000, "+" + "1(" * 100_000):
        p.base_spans(text)
        list(p.stretches(text))


def test_gradients():
    t = p.Training(embed=3, hidden=2, seed=1)
    model = p.Tagger.new(t)
    chars, tags = p.labelled_windows(p.Training(examples=3, seed=5))
    chars, tags = chars[:20], tags[:20].copy()
    tags[0] = np.where(np.char.startswith(np.array(p.TAGS)[tags[0]], "I"), tags[0] - 1, tags[0])
    _, grad = model.loss(chars, tags)
    rng = np.random.default_rng(0)
    for name, w in model.w.items():
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if name == "moves" and p.ALLOWED[at]:
                continue
            old, eps = w[at], 1e-5
            w[at] = old + eps
            up, _ = model.loss(chars, tags)
            w[at] = old - eps
            down, _ = model.loss(chars, tags)
            w[at] = old
            assert abs((up - down) / (2 * eps) - grad[name][at]) < 1e-5


def test_best_paths_are_best():
    import itertools

    model = p.Tagger.new(p.Training(embed=3, hidden=2))
    rng = np.random.default_rng(1)
    model.w["moves"] = rng.normal(size=model.w["moves"].shape)
    scores = rng.normal(size=(4, 5, len(p.TAGS)))
    moves, paths = model.moves(), model.best_paths(scores)

    def worth(path, b):
        steps = sum(moves[x, y] for x, y in zip(path, path[1:]))
        return p.START[path[0]] + steps + sum(scores[t, b, k] for t, k in enumerate(path))

    every = list(itertools.product(range(len(p.TAGS)), repeat=4))
    for b in range(5):
        assert abs(worth(paths[:, b], b) - max(worth(q, b) for q in every)) < 1e-9


def test_held_out_accuracy_and_reruns():
    model = p.train()
    chars, tags = p.labelled_windows(p.Training(examples=300, seed=77))
    found = model.best_paths(model.emissions(chars))
    assert (found == tags)[tags > 0].mean() > 0.95 and (found == tags).mean() > 0.97
    assert p.train(p.Training(steps=3)) is p.train(p.Training(steps=3))


def test_secrets_anywhere_and_over_windows():
    model = p.train()
    secret = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    for lead in (0, 1, 20, 31, 40, 63, 64, 500):
        text = "erth " * (lead // 5) + "x" * (lead % 5) + f' token = "{secret}" and on with the other'
        ((base, spans),) = p.find([text], model)
        assert base == [] and [text[a:b] for k, a, b in spans if k == "secret"] == [secret]


def test_parts_of_a_long_stretch():
    model, secret = p.train(), "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    text = " ".join(f'er token = "{secret}" th {i % 10}.0' for i in range(60))
    whole, cut = p.model_spans([text], model)[0], p.model_spans([text], model, most_windows=4)[0]
    secrets = {(a, b) for k, a, b in whole if k == "secret"}
    assert len(secrets) == 60 and len(secrets & {(a, b) for k, a, b in cut if k == "secret"}) >= 45


def test_a_stretch_read_in_parts_is_decoded_as_one():
    model, secret = p.train(), "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    text = " ".join(f'er token = "{secret}" th {i % 10}.0' for i in range(60))
    whole = p.model_spans([text], model)[0]
    assert sum(k == "secret" for k, _, _ in whole) == 60
    for most in (1, 2, 3, 4, 7, 50):
        assert p.model_spans([text], model, most_windows=most)[0] == whole


def test_rows(spark):
    rows = [(1, "mail a@b.cc", "x"), (1, "mail a@b.cc", "x"), (None, None, None), (2, "", "y"), (3, "x " * 50_000 + "1.2.3.4", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string").repartition(3)
    got = sorted(((r.doc_id or 0, r.n_email, r.n_ip, r.base_spans) for r in p.detect(docs).collect()))
    mail = (1, 1, 0, "email:5:11")
    assert got == [(0, 0, 0, ""), mail, mail, (2, 0, 0, ""), (3, 0, 1, "ip:100000:100007")]
    masked = p.mask(docs)
    assert masked.schema == docs.schema
    assert {(r.doc_id, r.text) for r in masked.collect() if r.doc_id != 3} == {(1, "mail <email>"), (None, None), (2, "")}
    assert p.detect(docs.limit(0)).collect() == [] == p.mask(docs.limit(0)).collect()
