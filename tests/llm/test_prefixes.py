import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wicketflow.llm import prefixes, queries, scan


def plain(rows):
    """Nodes from whole rebuilt texts; rows of (conv, turn, role, text)."""
    def key(r):
        role, text = r[2] or "", r[3] or ""
        sha = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        return (r[1] is not None, r[1] or 0, int.from_bytes(sha[16:24], "little", signed=True))

    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    members, ends = {}, {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + mine[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    below = {}
    for node in members:
        for d in range(len(node) + 1):
            below.setdefault(node[:d], []).append(node)
    out = []
    for node, held in members.items():
        def children(v):
            return [u for u in below[v] if len(u) == len(v) + 1]
        out.append((
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held),
            len(children(node)), sum(not children(u) for u in below[node]),
            sum((len(members[u]) - 1) * len(u[-1][1]) for u in below[node] if u),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def got(df):
    return sorted((tuple(r) for r in df.select(*prefixes.NODE).collect()), key=lambda r: r[:2])


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "conv_id long, turn long, role string, text string,"
                                 " place long, owner string")


def made_up(seed, n=240, longest=9):
    rng, rows = random.Random(seed), []
    words = ["", "a", "b", None, "naïve 😀", "yes"]
    for _ in range(n):
        c = rng.choice([0, 1, 2, 3, 7, 100, 105, 205, 1000, 1003, 10 ** 12, rng.randrange(1500)])
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["user", None, ""]),
                         rng.choice(words)))
    return rows


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert got(queries.op12_conversation_trie(spark, small)) == plain(rows)


@pytest.mark.parametrize("seed", range(3))
def test_odd_rows(spark, seed):
    rows = made_up(seed) + [(None, 1, "user", "lost"), (5, None, None, None)]
    rows += rows[:9]
    assert got(prefixes.trie(frame(spark, rows).repartition(3))) == plain(rows)


def test_copies_and_a_long_conversation(spark):
    rows = [(c, t, "user", f"say {t}") for c in range(0, 900, 3) for t in range(3)]
    rows += [(50, t, "user", str(t % 7)) for t in range(700)]
    rows += [(51, t, "user", str(t % 7)) for t in range(300)] + [(1, 0, "a", "b")]
    assert got(prefixes.trie(frame(spark, rows).repartition(5))) == plain(rows)


def test_empty_table_and_turnless_conversations(spark):
    assert prefixes.trie(frame(spark, made_up(1)).where("false")).count() == 0
    rows = [(c, 0, "user", "only") for c in range(101, 140)]
    assert got(prefixes.trie(frame(spark, rows))) == plain(rows)


def test_collisions_are_found_and_cured(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "BASES", ((2, 2, 2, 2),))
    monkeypatch.setattr(prefixes, "MODULI", (3, 5, 7, 3))
    with pytest.raises(RuntimeError, match="collide"):
        prefixes.trie(frame(spark, made_up(2)))
    monkeypatch.setattr(prefixes, "BASES", ((1, 1, 1, 1), (3, 5, 7, 11)))
    monkeypatch.setattr(prefixes, "MODULI", (2147483647, 2147483629, 2147483587, 2147483579))
    rows = [(100 + c, t, "", x) for c, word in enumerate(["abcd", "bacd", "cdab"])
            for t, x in enumerate("......" + word)]
    # Sums do not see the order of turns; products of other bases do.
    assert got(prefixes.trie(frame(spark, rows))) == plain(rows)


def test_running_values_along_keys_that_span_partitions(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3, 9]), i, rng.randrange(100), rng.randrange(101))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, o long, x long, y long").repartition(7)
    law = scan.Law(10, 101)
    made = scan.running(df, "k", [F.col("o").desc()], {"x": scan.Law(), "y": law}).collect()
    assert len(made) == len(rows)
    state = {}
    for r in sorted(made, key=lambda r: (r.k, -r.o)):
        x, y = next((x, y) for k, o, x, y in [rows[r.o]])
        n, sx, sy = state.get(r.k, (0, 0, 0))
        state[r.k] = (n + 1, sx + x, law.combine(n, sy, y))
        assert (r.place, r.x, r.y) == state[r.k]
