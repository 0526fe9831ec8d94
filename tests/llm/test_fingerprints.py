"""Locally consistent parsing against a plain version, and what fingerprints are for."""

import hashlib
import random

import numpy as np
import pytest

from siltstone.llm import fingerprints as fp

MASK = (1 << 64) - 1


def stir(x):
    x = ((x ^ (x >> 32)) * fp.STIR[0]) & MASK
    x = ((x ^ (x >> 29)) * fp.STIR[1]) & MASK
    return x ^ (x >> 32)


def toss(own, before):
    differ = (own ^ before) or 1
    place = (differ & -differ).bit_length() - 1
    return 2 * place + ((own >> place) & 1)


def plain_level(symbols):
    """Phrase names of one text, and the members of its long runs."""
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    repeated = [s for s, n in runs if n >= fp.LONG_RUN for _ in range(n)]
    repeated_names = []
    names = []
    for s, n in runs:
        names.append(stir((s + stir(n)) & MASK) if n > 1 else s)
    for (s, n) in runs:
        if n >= fp.LONG_RUN:
            repeated_names += [s] * n
    labels = [toss(s, s ^ 1 if i == 0 else names[i - 1]) for i, s in enumerate(names)]
    for _ in range(fp.TOSSES - 1):
        labels = [toss(x, x ^ 1 if i == 0 else labels[i - 1]) for i, x in enumerate(labels)]
    assert max(labels) < 6
    phrases = []
    for i, s in enumerate(names):
        opens = i == 0 or (i + 1 < len(names) and labels[i - 1] > labels[i] < labels[i + 1])
        if opens:
            phrases.append([])
        phrases[-1].append(s)
    out = []
    for phrase in phrases:
        total, power = 0, 1
        for s in phrase:
            power = (power * fp.POWER) & MASK
            total = (total + stir(s) * power) & MASK
        out.append(stir(total))
    return out, repeated_names


def plain_sketch(text):
    if not text:
        return [], 0
    symbols, kept, level = [ord(c) for c in text], [], 0
    while level < max(fp.LEVELS) or len(symbols) >= fp.PHRASES:
        symbols, repeated = plain_level(symbols)
        level += 1
        if level in fp.LEVELS or level > max(fp.LEVELS) and len(symbols) >= fp.PHRASES:
            kept += symbols + repeated
    seen, hashes = {}, set()
    for s in kept:
        n = seen[s] = seen.get(s, -1) + 1
        hashes.add(stir((s + n * fp.STIR[0]) & MASK) >> 32)
    return sorted(hashes)[: max(fp.KEPT, len(hashes) // fp.SHARE)], len(hashes)


def plain_likeness(a, b):
    bound = min([s[-1] for s, n in (a, b) if len(s) < n], default=1 << 40)
    one, other = ({x for x in s if x <= bound} for s, _ in (a, b))
    return len(one & other) / len(one | other) if one | other else 1.0


def words(rng, n):
    return " ".join("".join(rng.choices(["th", "er", "ou", "ing", "a", "ble", "st", "é"], k=rng.randint(1, 4))) for _ in range(n))


TEXTS = ["", "a", "aa", "ab", "aaaaaaaaaaab", "Das " * 500, "abab" * 99 + "x", "\U0001f600é語" * 7] + [
    words(random.Random(i), i * 7 % 200) for i in range(60)]


def test_sketches_are_those_of_the_plain_version():
    texts = [*TEXTS, words(random.Random(99), 6000)]
    assert [s.tolist() for s, _ in fp.sketches(texts)] == [plain_sketch(t)[0] for t in texts]
    assert [fp.sketches([t])[0][0].tolist() for t in texts] == [plain_sketch(t)[0] for t in texts]
    for a, b in zip(fp.sketches(texts), fp.sketches(texts[1:])):
        assert fp.likeness(a, b) == fp.likeness(b, a) and fp.likeness(a, a) == 1


def test_long_texts_tell_how_much_they_share():
    rng = random.Random(12)
    own, other, more = ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=100_000)) for _ in range(3))
    near = [fp.likeness(*fp.sketches([own, other[:-n] + own[50_000 : 50_000 + n] if n else other])) for n in (0, 300, 1000, 3000, 10_000)]
    assert near == sorted(near) and near[3] > 4 * near[1] and near[3] > 0.008 and near[4] > 0.035
    edited = fp.edited_text(own, more)
    assert abs(fp.likeness(*fp.sketches([own, edited])) - 0.5) < 0.04


def test_a_passage_keeps_its_names_at_any_offset():
    rng = random.Random(5)
    passage = words(rng, 300)
    for before in ("", "x", words(rng, 3), words(rng, 50)):
        text = before + " " + passage + " " + words(rng, 20)
        shared = plain_likeness(plain_sketch(passage), plain_sketch(text))
        assert shared > len(passage) / len(text) * 0.75
    assert plain_likeness(plain_sketch(passage), plain_sketch(words(rng, 300))) < 0.1


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, part string, top int")


@pytest.mark.parametrize("chunk", [1 << 19, 1500])
def test_rows(spark, monkeypatch, chunk):
    monkeypatch.setattr(fp, "CHUNK", chunk)
    rows = [(i * 3, t or None, "clash", 1) for i, t in enumerate(TEXTS)]
    got = sorted(map(tuple, fp.fingerprints(frame(spark, rows).repartition(5)).collect()))
    expected = []
    order = sorted(rows, reverse=True)
    for at, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(at + 1) % len(order)][1] or ""
        third = len(t) // 3
        edited = t[: len(t) - third] + after[:third]
        own, changed, following = plain_sketch(t), plain_sketch(edited), plain_sketch(after)
        digits = lambda s: "".join(f"{x:08x}" for x in s[0])
        expected.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), digits(own), digits(changed),
                         plain_likeness(own, changed), plain_likeness(own, following)))
    assert got == sorted(expected)


def test_odd_tables(spark):
    assert fp.fingerprints(frame(spark, [])).count() == 0
    only = fp.fingerprints(frame(spark, [(7, "abcdef", "x", 1)])).collect()
    assert len(only) == 1 and only[0].near_next == 1.0
    rows = [(None, "null id", "x", 1), (None, None, "x", 1)] + [(4, f"same id {i % 2}", "x", 1) for i in range(20)] + [(9, "nine", "x", 1)]
    got = fp.fingerprints(frame(spark, rows).repartition(3)).collect()
    assert len(got) == len(rows) and sum(r.doc_id is None for r in got) == 2
    assert len({r.fingerprint for r in got if r.doc_id == 4}) == 2
    assert np.isfinite([r.near_next for r in got]).all()
