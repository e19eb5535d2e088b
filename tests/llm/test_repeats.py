import hashlib
import random

import numpy as np
import pytest

from tablemargin.llm import repeats


def brute(rows, length=50):
    least = {}
    for i, text in rows:
        data = (text or "").encode()
        if i is not None:
            for k in range(len(data) - length + 1):
                s = data[k:k + length]
                least[s] = min(least.get(s, i), i)
    out = []
    for i, text in rows:
        data = (text or "").encode()
        stays = np.ones(len(data), bool)
        for k in range(len(data) - length + 1):
            if i is not None and least[data[k:k + length]] < i:
                stays[k:k + length] = False
        spans = sum(not s and (k == 0 or stays[k - 1]) for k, s in enumerate(stays))
        kept = bytes(b for b, s in zip(data, stays) if s)
        out.append((i, len(data), int((~stays).sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def texts(rng, n):
    """Random texts with shared passages of all lengths around the threshold, in few letters, with copies and edits."""
    letters = rng.choice(["ab", "abcdefgh é", "abcdefghijklmnopqrstuvwxyz  äß漢"])
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [word(rng.randrange(20, 140)) for _ in range(6)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([word(rng.randrange(0, 60)), rng.choice(shared), rng.choice(shared)[rng.randrange(20):]]) for _ in range(rng.randrange(0, 6)))
        if rows and rng.random() < 0.3:
            text = rng.choice(rows)[1] or ""
            if text and rng.random() < 0.6:
                k = rng.randrange(len(text))
                text = text[:k] + "#" + text[k + 1:]
        rows.append((rng.choice([rng.randrange(-5, 200), rng.randrange(-5, 200), None]), rng.choice([text, text, text, text, None])))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, documents, monkeypatch, seed):
    rng = random.Random(seed)
    # Many small chunks and buckets, so that all meet between tasks, too.
    monkeypatch.setattr(repeats, "CHUNK", rng.choice([150, 2000]))
    monkeypatch.setattr(repeats, "BUCKET", rng.choice([50, 10 ** 6]))
    rows = texts(rng, 120) + [(1, "x" * 49), (2, "x" * 49), (3, "x" * 51), (4, "x" * 300), (500, "x" * 50), (500, "x" * 50)]
    rng.shuffle(rows)
    assert result(repeats.digests(documents(rows).repartition(3))) == brute(rows)
    if seed < 2:
        length = rng.choice([33, 40, 62])
        assert result(repeats.digests(documents(rows), length)) == brute(rows, length)


def test_sampled_positions_follow_from_the_bytes():
    rng = np.random.default_rng(3)
    # Longer than the steps the positions are found in, and low in entropy.
    data = rng.integers(0, 2, 400_000).astype(np.uint8)
    at, ranks = repeats.sampled(data, np.array([0]), np.array([len(data)]))
    here = np.zeros(len(data) + 1, int)
    here[at + 1] = 1
    reached = np.cumsum(here)
    # A position inside every string of 50 bytes.
    assert all(reached[50 - 31:len(data) - 31 + 1] - reached[:len(data) - 49] > 0)
    for begin in rng.integers(0, len(data) - 3000, 20):
        part_at, part_ranks = repeats.sampled(data[begin:begin + 3000], np.array([0]), np.array([3000]))
        inner = (at >= begin + 50) & (at < begin + 2900)
        theirs = (part_at >= 50) & (part_at < 2900)
        assert (part_at[theirs] + begin == at[inner]).all() and (part_ranks[theirs] == ranks[inner]).all()


def test_long_texts_and_empty_table(spark, documents):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefg \n") for _ in range(5_000_000))
    rows = [(9, long), (3, long[1_000_000:1_000_100]), (10, "z" + long[4_000_000:4_000_060] + "z"), (11, "a" * 3_000_000), (12, "a" * 60)]
    got = {r.doc_id: r for r in repeats.remove_repeats(documents(rows)).collect()}
    assert (got[9].n_removed, got[9].n_spans, got[3].n_removed) == (100, 1, 0)
    assert (got[10].n_removed, got[10].kept) == (60, b"zz") and got[11].n_removed == 0 and got[12].n_removed == 60
    assert repeats.digests(documents(rows).limit(0)).count() == 0
