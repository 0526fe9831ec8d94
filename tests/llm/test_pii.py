"""Personal data: base patterns against plain expressions, message passing against sums over all labelings."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import pii
from siltstone.llm.pii import Weights, base_spans, graph_of, labelled_spans, linked_spans, luhn, marginals, personal_data, train, training_rows

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return re.sub("[^0-9]", "", m)


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return sorted(spans + [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15])


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from([
    "a", "B.", "@", "x.y", "-", "_%", "+", "1", "23", "255", "256", ".", " ", "(", ")", "+1 (269) 555-32", "4111 1111 1111 1111", "é", "0" * 12,
    "1.2.3.4", "a@b.c", "+12", "\n", "４", "5500-0000-0000-0004", "999999999999.1.1.1"]), max_size=14).map("".join))
def test_base_spans(text):
    assert base_spans(text) == plain(text)


def test_long_texts_take_little_time():
    for text in ("1" * 200_000, "a." * 100_000, "a@" * 100_000, "1.1" * 60_000, "+1" * 100_000, "+" + "1 (" * 60_000, "x" * 200_000 + "@"):
        assert isinstance(base_spans(text), list)
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def joint(unary, links, w):
    """Marginals by summing over every labeling."""
    n, k = unary.shape
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(unary[i, y] for i, y in enumerate(labels)) + sum(w.links[t] * (labels[a] == labels[b]) for a, b, t in links))
        for i, y in enumerate(labels):
            total[i, y] += weight
    return total / total[0].sum()


@pytest.mark.parametrize("links", [[], [(0, 1, 0)], [(0, 1, 0), (1, 2, 1), (1, 3, 2)], [(0, 1, 1), (1, 2, 1), (2, 3, 0), (3, 4, 2)]])
def test_messages_are_exact_on_trees(links):
    rng = np.random.default_rng(1)
    unary, w = rng.normal(size=(5, 3)), Weights()
    got = marginals(unary, np.array(links, np.int64).reshape(-1, 3), w, rounds=80)
    assert np.allclose(got, joint(unary, links, w), atol=1e-6)


def test_messages_are_close_on_loops():
    rng = np.random.default_rng(2)
    unary, w = rng.normal(size=(4, 3)), Weights(links=np.array([0.4, 0.8, 0.6]))
    links = [(0, 1, 0), (1, 2, 1), (2, 3, 2), (3, 0, 0)]
    got = marginals(unary, np.array(links), w, rounds=80)
    assert np.abs(got - joint(unary, links, w)).max() < 0.05


TEXT = "Call +1 (269) 555-0132 or mail john.smith@example.com. Later: 269-555-0132, John Smith, order 12345678901."


def test_other_mentions_are_linked():
    found = [TEXT[a:b] for a, b in linked_spans(TEXT, base_spans(TEXT), Weights())]
    assert found == ["269-555-0132", "John Smith"]
    alone = TEXT.replace("+1 (269) 555-0132", "us").replace("john.smith@example.com", "us")
    assert linked_spans(alone, base_spans(alone), Weights()) == []


def test_planted_repeats_are_found_with_their_kind():
    """Repeats of a mention in other spellings, among numbers and names that belong to nobody in the document."""
    rng = random.Random(11)
    first, last = ("anna", "boris", "carla", "dmitri", "elena", "farid"), ("keller", "moreau", "novak", "okafor", "petrov", "quinn")
    planted = found = right = wrong = 0
    for _ in range(200):
        area, mid, end = rng.randrange(200, 999), rng.randrange(200, 999), rng.randrange(1000, 9999)
        a, b = rng.choice(first), rng.choice(last)
        again = [(3, f"{area} {mid} {end}"), (3, f"({area}) {mid}-{end}"), (0, f"{a} {b}".title()), (0, f"{a}_{b}"), (3, f"{area}.{mid}.{end}")]
        noise = [f"order {rng.randrange(10**8, 10**9)}", f"item {rng.randrange(10**11, 10**12)}", "Maria Lindqvist", f"in {rng.randrange(1900, 2030)}"]
        said = [(None, n) for n in noise] + again
        rng.shuffle(said)
        text, spans = f"Write to {a}.{b}@example.com or call +1 {area} {mid} {end}.", set()
        for kind, piece in said:
            text += " Then some words stand here, and "
            if kind is not None:
                spans.add((len(text), kind, len(text) + len(piece)))
            text += piece
        got = set(labelled_spans(text, base_spans(text), Weights()))
        planted, found, wrong = planted + len(spans), found + len(got & spans), wrong + len(got - spans)
        right += sum((s, e) in {(x, z) for x, _, z in got} for s, _, e in spans)
    assert right / planted >= 0.99 and found / planted >= 0.99 and wrong / (found + wrong) <= 0.01, (planted, right, found, wrong)


def test_many_names_take_little_time():
    names = [f"user{i:05d}.name{i * 7 % 9973}" for i in range(20_000)]
    text = " ".join(f"{n}@example.com" for n in names) + " " + " ".join(n.replace(".", " ").upper() for n in names[:3000])
    start = time.perf_counter()
    found = linked_spans(text, base_spans(text), Weights())
    assert len(found) == 3000 and time.perf_counter() - start < 5


def test_repeated_mentions_make_as_many_links():
    text = "+1 269 555 0132, " * 3000 + "269 555 0132 and more " * 3000
    graph = graph_of(text, base_spans(text))
    assert len(graph.spans) == 6000 and len(graph.links) < 4 * 6000


def test_training_learns_links_and_keeps_the_defaults_without_rows():
    rng = random.Random(3)
    rows = []
    for _ in range(200):
        number = f"+1 {rng.randrange(200, 999)} {rng.randrange(200, 999)} {rng.randrange(1000, 9999)}"
        rows += training_rows(f"{number} words then {number} and 12345{rng.randrange(1000, 9999)}", lambda i: i % 2 == 0)
    w = train(*(np.array(c) for c in zip(*rows)))
    assert w.links[1] > 2.5 and w.evidence > 4
    none = train(*[np.empty(0)] * 4)
    assert none.evidence == Weights().evidence and (none.links == Weights().links).all()


def test_rows(spark):
    texts = [None, "", TEXT, "no data at all", "\U0001f600 10.0.0.1 256.1.1.1 a@b.co", "word " * 30000 + "+49 (30) 1234-5678", TEXT] + [
        f"mail u{i}@example.org and 4111 1111 1111 1111" for i in range(60)]
    df = spark.createDataFrame([(i % 50, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(3)
    got = sorted(map(tuple, personal_data(df).collect()))
    weights = pii.trained_weights(df)
    expected = []
    for i, t in enumerate(texts):
        base = plain(t or "")
        every = sorted(base + [(a, 4 + k, b) for a, k, b in labelled_spans(t or "", base, weights)])
        names = ["email", "ip", "card", "phone", "linked_email", "linked_ip", "linked_card", "linked_phone"]
        write = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for a, k, b in spans)
        expected.append((i % 50, *[sum(s[1] == k for s in base) for k in range(4)], hashlib.sha256(write(base).encode()).hexdigest(),
                         write(every), len(every) - len(base)))
    assert got == sorted(expected)
    assert any(r[-1] for r in got) and any("linked_phone" in r[6] and "linked_email" in r[6] for r in got)


def test_empty_table(spark):
    assert personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 20, 1000])
def test_repeats_do_not_outvote_a_mention(n):
    for again in ("269 555 0132", "+1 269 555 0132 x 269 555 0132", "12695550132", "0269 555 0132; 269 555 0132"):
        text = "+1 269 555 0132 is the number" + (". Some words stand between the two: " + again) * n
        base = base_spans(text)
        graph = graph_of(text, base)
        others = [span for span, kind in zip(graph.spans, graph.kinds) if kind == pii.NONE]
        assert len(others) >= n and linked_spans(text, base, Weights()) == others


def test_documents_without_base_spans_are_judged_alike():
    w = Weights(nothing=1.65)
    w.shapes[2, [0, 2, 4]] = -0.97, 0.99, 0.97
    alone, beside = "Call 269 555 0132 today", "Call 269 555 0132 today" + " and so on" * 9 + " a@b.co"
    found = linked_spans(beside, base_spans(beside), w)
    assert base_spans(alone) == [] and base_spans(beside) and found == linked_spans(alone, [], w) == [(5, 17)]
    assert linked_spans(alone, [], Weights()) == []
    assert training_rows(alone, lambda i: False) == [(0, 0, 2, [0.0] * 15)]
