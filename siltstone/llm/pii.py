"""Personal data by patterns and a skip-chain conditional random field.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers;
these base spans are always reported. Other number groups and spellings of a
found address's name are further nodes of the document's graph. Neighbouring
nodes are linked in a chain, and nodes anywhere in the document that are equal
or similar, by their digits or letters, are linked across it. Loopy belief
propagation then carries what is known of one mention to the others: a node
that is more likely personal data than not is reported with the likeliest kind,
as ``linked_phone`` for a phone number written without its country sign after it
was given in full, so equal and similar tokens of a document have one label.
Documents without a base span are judged by the same field.

Base mentions are certain. Equal mentions share one variable, and similar ones
are linked to a base mention where there is one, so a number is judged alike whether it occurs once
or a thousand times. Messages are passed until they settle. The weights are trained by pseudo-likelihood
on a bounded sample of documents: the patterns' labels, half of them hidden so
that links are learned, pulled towards the defaults where the sample says little.

Defined results: null or empty text has no spans; rows with equal ids are
separate rows; an empty table gives an empty result; a very long text is one
task's graph, in time proportional to its nodes and their links; other columns
do not matter.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.keys import text_of
from siltstone.session import ship_package

# The kinds in the order in which they are listed, and their patterns and bounds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, *[f"linked_{k}" for k in BASE])
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

# Other nodes: groups of at least seven digits. Nodes whose last seven digits agree are similar.
NUMBERS = re.compile(r"[0-9(][0-9(). -]*[0-9]")
SIMILAR_DIGITS = 7
# Letters and digits that a name in an address has at least.
NAME_SIGNS = 6
# Separating signs between the parts of a name at most.
NAME_GAP = 2
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Characters between neighbours of the chain at most.
CHAIN_GAP = 24

# Labels are none and the base kinds. Links: neighbours, equal nodes, similar nodes.
NONE, LABELS = 0, 1 + len(BASE)
CHAIN, SAME, SIMILAR = range(3)
# Messages are settled when none moves by more than SETTLED; ROUNDS bounds those that swing.
ROUNDS, SETTLED, DAMPING = 1000, 1e-8, 0.3
REPORTED = 0.5
# What fixes the label of a base mention, which is reported in any case, so that no number of other mentions outvotes it.
CERTAIN = 50.0

# Documents in the training sample and nodes of each; steps and pull of the training.
TRAIN_ROWS, TRAIN_NODES = 2000, 200
STEPS, RATE, PULL = 200, 0.5, 0.02


@dataclass
class Weights:
    """Log-potentials: a pattern's label, no label without a pattern, links by kind, labels by shape."""

    evidence: float = 6.0
    nothing: float = 3.0
    links: np.ndarray = field(default_factory=lambda: np.array([0.1, 5.0, 4.0]))
    shapes: np.ndarray = field(default_factory=lambda: np.zeros((len(SHAPES), LABELS)))


SHAPES = ("letters", "7 to 9 digits", "10 to 13 digits", "14 or more digits", "fewer digits")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: around each sign, as far left as the pattern allows."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL_PART.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in order."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    first = re.search("[0-9]", text)
    if first:
        begin = max(0, first.start() - 1)
        spans += [(m.start(), 1, m.end()) for m in IP.finditer(text, begin) if max(map(_number, m[0].split("."))) <= 255]
        for m in CARD.finditer(text, begin):
            if m.end() - m.start() >= CARD_DIGITS[0]:
                digits = _digits(m[0])
                if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        if "+" in text:
            spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text)
                      if PHONE_DIGITS[0] <= len(_digits(m[0])) <= PHONE_DIGITS[1]]
    return sorted(spans)


def _number(part: str) -> int:
    return int(part) if len(part) <= 9 else 256 if part.strip("0") and len(part.lstrip("0")) > 9 else int(part.lstrip("0")[-9:] or 0)


@dataclass
class Graph:
    """Nodes of a document and their links."""

    spans: list[tuple[int, int]]
    kinds: np.ndarray  # label of the pattern, NONE for other nodes
    shapes: np.ndarray
    links: np.ndarray  # (a, b, kind of link)
    equal: list[str]  # what equal nodes share
    similar: list[str | None]  # what similar nodes share


def _free(spans: list[tuple[int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none that is taken; both are in order."""
    out, at = [], 0
    for a, b in spans:
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if at == len(taken) or taken[at][0] >= b:
            out.append((a, b))
    return out


def _spellings(text: str, names: set[tuple[str, ...]], taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Where the parts of an address's name stand together, with up to two separating signs between them.

    One automaton finds all names in the text without its separating signs; what
    stood between the letters decides afterwards.
    """
    if not names:
        return []
    by_letters: dict[str, list[tuple[int, ...]]] = {}
    for parts in sorted(names):
        by_letters.setdefault("".join(parts), []).append(tuple(itertools.accumulate(map(len, parts))))
    automaton = ahocorasick.Automaton()
    for letters, ends in by_letters.items():
        automaton.add_word(letters, (len(letters), ends))
    automaton.make_automaton()
    place = [i for i, c in enumerate(text) if c not in "._-" and not c.isspace()]
    squeezed = "".join([text[i] for i in place]).translate(LOWER)
    found = []
    for last, (length, all_ends) in automaton.iter(squeezed):
        spot = place[last - length + 1 : last + 1]
        a, b = spot[0], spot[-1] + 1
        if a and text[a - 1].isalnum() or b < len(text) and text[b].isalnum():
            continue
        gaps = [(k, spot[k] - spot[k - 1] - 1) for k in range(1, length) if spot[k] - spot[k - 1] > 1] if b - a > length else []
        if any(all(gap <= NAME_GAP and k in ends for k, gap in gaps) for ends in all_ends):
            found.append((a, b))
    out: list[tuple[int, int]] = []
    for span in _free(sorted(set(found)), taken):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph:
    taken: list[tuple[int, int]] = []
    for a, _, b in base:
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    others = [m.span() for m in NUMBERS.finditer(text) if m.end() - m.start() >= SIMILAR_DIGITS and len(_digits(m[0])) >= SIMILAR_DIGITS]
    names = set()
    for a, kind, b in base:
        if kind == 0:
            parts = tuple(p.lower() for p in re.split(r"[^A-Za-z0-9]+", text[a:b].split("@")[0]) if p)
            if sum(map(len, parts)) >= NAME_SIGNS:
                names.add(parts)
    others = _free(others, taken)
    others += _spellings(text, names, sorted(taken + others))
    nodes = sorted([(a, b, kind + 1) for a, kind, b in base] + [(a, b, NONE) for a, b in others])

    links, last_same, last_similar = [], {}, {}
    shapes, equal, alike = [], [], []
    for i, (a, b, kind) in enumerate(nodes):
        if i and a - nodes[i - 1][1] <= CHAIN_GAP:
            links.append((i - 1, i, CHAIN))
        piece = text[a:b]
        digits = _digits(piece)
        named = kind == 1 or not digits or any(c.isalpha() for c in piece)
        if named:
            local = piece.split("@")[0].lower()
            same, similar = "".join(c for c in local if c.isalnum()), None
        else:
            same, similar = digits, digits[-SIMILAR_DIGITS:] if kind != 2 and len(digits) >= SIMILAR_DIGITS else None
        shapes.append(0 if named else 4 if len(digits) < 7 else 1 if len(digits) < 10 else 2 if len(digits) < 14 else 3)
        equal.append(same)
        alike.append(similar)
        linked = last_same.get(same)
        if linked is not None:
            links.append((linked, i, SAME))
        last_same[same] = i
        if similar is not None:
            near = last_similar.get(similar)
            if near is not None and near != linked:
                links.append((near, i, SIMILAR))
            last_similar[similar] = i
    return Graph(
        [(a, b) for a, b, _ in nodes], np.array([k for *_, k in nodes], np.int64), np.array(shapes, np.int64),
        np.array(links, np.int64).reshape(-1, 3), equal, alike)


def shared(graph: Graph) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variable of every node, a node of every variable, links of variables): equal nodes of one label and shape are one variable."""
    number: dict[tuple, int] = {}
    keys = zip(graph.equal, graph.kinds.tolist(), graph.shapes.tolist())
    of = np.array([number.setdefault(key, len(number)) for key in keys], np.int64)
    first = np.unique(of, return_index=True)[1]
    links = {(min(a, b), max(a, b), kind) for a, b, kind in zip(of[graph.links[:, 0]].tolist(), of[graph.links[:, 1]].tolist(), graph.links[:, 2].tolist()) if a != b}
    # Similar variables hear a base mention at first hand.
    known = {}
    for i in first.tolist():
        if graph.kinds[i] != NONE and graph.similar[i] is not None:
            known.setdefault(graph.similar[i], i)
    for i in first.tolist():
        base = known.get(graph.similar[i])
        if base is not None and graph.kinds[i] == NONE and graph.equal[i] != graph.equal[base]:
            a, b = sorted((int(of[i]), int(of[base])))
            links.add((a, b, SIMILAR))
    return of, first, np.array(sorted(links), np.int64).reshape(-1, 3)


def unaries(kinds: np.ndarray, shapes: np.ndarray, w: Weights) -> np.ndarray:
    """Log-potentials of every node's labels."""
    out = w.shapes[shapes].copy()
    out[:, NONE] += np.where(kinds == NONE, w.nothing, 0.0)
    seen = kinds != NONE
    out[seen, kinds[seen]] += w.evidence
    return out


def marginals(unary: np.ndarray, links: np.ndarray, w: Weights, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities after loopy sum-product messages, both ways along every link."""
    def normal(x: np.ndarray) -> np.ndarray:
        return x - np.logaddexp.reduce(x, axis=1, keepdims=True)

    belief = normal(unary)
    if len(links):
        n = len(links)
        source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
        bonus = np.concatenate([w.links[links[:, 2]]] * 2)[:, None]
        message = np.zeros((2 * n, unary.shape[1]))
        for _ in range(rounds):
            total = unary.copy()
            np.add.at(total, target, message)
            rest = normal(total[source] - message[back])
            # Equal labels get the bonus: the sum over all labels, with the own label's part raised.
            sent = normal(np.log(1.0 + np.expm1(bonus) * np.exp(rest)))
            moved = np.abs(sent - message).max()
            message = DAMPING * message + (1 - DAMPING) * sent
            if moved < SETTLED:
                break
        total = unary.copy()
        np.add.at(total, target, message)
        belief = normal(total)
    return np.exp(belief)


def labelled_spans(text: str, base: list[tuple[int, int, int]], w: Weights) -> list[tuple[int, int, int]]:
    """(start, base kind, end) of the other mentions, each with its likeliest kind."""
    graph = graph_of(text, base)
    if (graph.kinds != NONE).all():
        return []
    of, first, links = shared(graph)
    kinds = graph.kinds[first]
    unary = unaries(kinds, graph.shapes[first], w)
    unary[kinds != NONE, kinds[kinds != NONE]] += CERTAIN
    p = marginals(unary, links, w)[of]
    chosen = (graph.kinds == NONE) & (1 - p[:, NONE] > REPORTED)
    label = p[:, 1:].argmax(axis=1)
    return [(graph.spans[i][0], int(label[i]), graph.spans[i][1]) for i in np.flatnonzero(chosen)]


def linked_spans(text: str, base: list[tuple[int, int, int]], w: Weights) -> list[tuple[int, int]]:
    return [(a, b) for a, _, b in labelled_spans(text, base, w)]


# Training: pseudo-likelihood of the patterns' labels.


def training_rows(text: str, hide) -> list[tuple]:
    """(label, seen label, shape, neighbours with each label by kind of link) of a document's first nodes.

    Other nodes that are linked to a mention are left out: whether they are personal data is the question.
    """
    graph = graph_of(text, base_spans(text))
    around = np.zeros((len(graph.spans), 3, LABELS))
    for a, b, kind in graph.links:
        around[a, kind, graph.kinds[b]] += 1
        around[b, kind, graph.kinds[a]] += 1
    return [
        (int(k), int(NONE if hide(i) else k), int(s), around[i].reshape(-1).tolist())
        for i, (k, s) in enumerate(zip(graph.kinds[:TRAIN_NODES], graph.shapes))
        if k != NONE or not around[i, SAME:, 1:].any()
    ]


def train(label: np.ndarray, seen: np.ndarray, shape: np.ndarray, around: np.ndarray) -> Weights:
    """Gradient steps from the prior, with a pull back to it; weights are rounded so that they do not hang on summation order."""
    prior, w = Weights(), Weights()
    n = len(label)
    if not n:
        return w
    around = around.reshape(n, 3, LABELS)
    truth = np.eye(LABELS)[label]
    evidence = np.eye(LABELS)[seen] * (seen != NONE)[:, None]
    nothing = np.zeros((n, LABELS))
    nothing[seen == NONE, NONE] = 1
    for _ in range(STEPS):
        logit = w.evidence * evidence + w.nothing * nothing + np.einsum("nkl,k->nl", around, w.links) + w.shapes[shape]
        p = np.exp(logit - np.logaddexp.reduce(logit, axis=1, keepdims=True))
        error = (truth - p) / n
        by_shape = np.zeros_like(w.shapes)
        np.add.at(by_shape, shape, error)
        w.evidence += RATE * ((error * evidence).sum() - PULL * (w.evidence - prior.evidence))
        w.nothing += RATE * ((error * nothing).sum() - PULL * (w.nothing - prior.nothing))
        w.links = w.links + RATE * (np.einsum("nl,nkl->k", error, around) - PULL * (w.links - prior.links))
        w.shapes = w.shapes + RATE * (by_shape - PULL * w.shapes)
    return Weights(round(w.evidence, 2), round(w.nothing, 2), np.round(np.maximum(w.links, 0), 2), np.round(w.shapes, 2))


def trained_weights(docs: DataFrame) -> Weights:
    """Weights from the TRAIN_ROWS different documents with the smallest hashes among those that may hold a mention.

    The bound is found among hashes alone, so no task sends more than numbers for it; then every task trains on its own texts below it.
    """
    hashed = docs.select("text", F.xxhash64("doc_id", "text").alias("hash")).where(F.col("text").rlike("[0-9@]"))
    bound = hashed.select("hash").orderBy("hash").limit(TRAIN_ROWS).agg(F.max("hash").alias("bound")).first()["bound"]
    if bound is None:
        return Weights()
    sample = hashed.where(F.col("hash") <= bound).groupBy("hash").agg(F.first("text").alias("text")).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                rows += training_rows(text.as_py(), lambda i, n=len(text.as_py()): (i * 7 + n) % 2 == 0)
            yield pa.RecordBatch.from_pydict(
                {k: [r[c] for r in rows] for c, k in enumerate(("label", "seen", "shape", "around"))},
                pa.schema([("label", pa.int32()), ("seen", pa.int32()), ("shape", pa.int32()), ("around", pa.list_(pa.float64()))]))

    rows = sorted(map(tuple, sample.mapInArrow(run, "label int, seen int, shape int, around array<double>").collect()))
    if not rows:
        return Weights()
    label, seen, shape, around = (np.array(c) for c in zip(*rows))
    return train(label, seen, shape, around)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_linked."""
    ship_package(docs.sparkSession)
    weights = trained_weights(docs)
    names = [*[f"n_{k}" for k in BASE], "n_linked"]
    schema = T.StructType(
        [docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in names[:-1]], T.StructField("base_sha256", T.StringType()),
         T.StructField("spans", T.StringType()), T.StructField(names[-1], T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                base = base_spans(text)
                every = sorted(base + [(a, len(BASE) + k, b) for a, k, b in labelled_spans(text, base, weights)])
                counts.append([*[sum(s[1] == k for s in base) for k in range(len(BASE))], len(every) - len(base)])
                digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
                spans.append(listed(every))
            by_kind = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *by_kind[:-1], pa.array(digests, pa.string()), pa.array(spans, pa.string()), by_kind[-1]],
                names=schema.names)

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(run, schema)
