import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tablemargin.llm import prefix_trie

SCHEMA = "conv_id long, turn int, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def sequences(rows, rebuild):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    if not rebuild:
        return own
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(rows, rebuild):
    nodes = {}
    for c, s in sequences(rows, rebuild).items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append((c, len(s)))
    out = []
    for p, members in nodes.items():
        below = [q for q in nodes if q[:len(p)] == p]
        parents = {q[:-1] for q in nodes if q}
        ends = sorted(c for c, n in members if n == len(p))
        out.append((min(members)[0], len(p), min(nodes[p[:-1]])[0] if p else None, len(members), sum(len(q) == len(p) + 1 for q in below),
                    sum(q not in parents for q in below), sum((len(nodes[q]) - 1) * len(q[-1][1].encode()) for q in below if q),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def talk(rng):
    rows = [(None, 0, "user", "x"), (3, None, None, None), (3, 0, "user", "é"), (3, 0, "user", "é"), (3, 0, "bot", "é"), (-7, 0, "user", "a"), (-5, 1, "user", "a")]
    for c in rng.sample(range(-20, 10_000), 60):
        rows += [(c, t, rng.choice(["user", "bot", "bot"]), rng.choice(["a", "a", "bb", "", "ü"])) for t in range(rng.randrange(1, 14))]
    for c in range(40, 55):
        rows += [(c, t, "user", "a") for t in range(c % 3 + 8)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rebuild", [False, True])
@pytest.mark.parametrize("block", [1, 3, 4])
def test_against_brute_force(spark, rebuild, block):
    rows = talk(random.Random(block))
    df = spark.createDataFrame(rows, SCHEMA)
    # Names that the operator uses inside do no harm.
    df = df.withColumns({"depth": F.lit(1), "place": F.lit(2), "owner": F.lit(3)})
    assert result(prefix_trie.conversation_trie(df, rebuild, block)) == brute(rows, rebuild)


def test_ends_on_several_pages(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PAGE", 3)
    rows = [(c, 0, "user", "same") for c in range(-20, 60)]
    assert result(prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows, False)


def test_empty_and_very_long(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], SCHEMA), True).count() == 0
    long = "x" * 3_000_000
    rows = [(1, 0, "u", long), (2, 0, "u", long), (2, 1, "u", "")] + [(3, t, "u", str(t)) for t in range(3000)]
    got = {(r.conv_id, r.depth): r for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 3003 and got[1, 0].saved_tokens == len(long) and got[1, 0].n_leaves == 2 and got[3, 1].n_leaves == 1
