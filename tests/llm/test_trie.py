import hashlib
import random
import zlib

import duckdb
import pytest

from lakeforge.llm import trie
from lakeforge.llm.queries import op12_conversation_trie
from lakeforge.llm.sql import ORACLE_SQL

from ..conftest import SF_SMALL
from .fixtures import same

SCHEMA = "conv_id long, turn long, role string, text string, id string, pos int, band string, parent string"


def brute(rows):
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends = {}, {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = int(c / 100) * 100  # towards zero
        full = tuple(own.get(base, [])[:h] + v[h:])
        for d in range(len(full) + 1):
            members.setdefault(full[:d], []).append(c)
        ends.setdefault(full, []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + ((len(m) - 1) * len(p[-1][1]) if p else 0)
    return [(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items()]


def table(spark, rows):
    return spark.createDataFrame([(*r, "i", 1, "b", "p") for r in rows], SCHEMA).repartition(3)


def talks(seed, convs, longest, texts=3):
    """Conversations that share turns often, in no order."""
    r = random.Random(seed)
    rows = []
    for c in convs:
        rows += [(c, t, r.choice(["user", "bot", None]) if r.random() < 0.2 else "user", r.choice([None, "", "é日", "x" * 40][:texts]) if t % 4 else "hello")
                 for t in range(r.randint(1, longest))]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [2, 3, 16])
def test_against_brute_force(spark, height):
    rows = talks(1, [*range(0, 40), *range(90, 230, 3), -5, -100, -170, 500, 501], 9)
    rows += [(7, None, "user", "first"), (None, 1, "user", "nobody"), (None, None, None, None)]
    same(trie.prefix_trie(table(spark, rows), height).collect(), brute(rows))


def test_long_conversations_and_copies(spark):
    long = [(c, t, "user", f"turn {t}" if t != 130 or c != 3 else "other") for c in (1, 2, 3, 100, 700) for t in range(150 if c != 2 else 97)]
    copies = [(1000 + c, t, "user", "same" * (t + 1)) for c in range(300) for t in range(7)]  # a third of all rows
    for rows in (long, long + copies):
        for height in (3, 16):
            same(trie.prefix_trie(table(spark, rows), height).collect(), brute(rows))


def test_ends_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "same") for c in range(0, 40_000, 100)]
    monkeypatch.setattr(trie, "PIECE_BYTES", 30)
    same(trie.prefix_trie(table(spark, rows)).collect(), brute(rows))


def test_ties_and_repeated_rows(spark):
    rows = [(0, 1, "a", "x"), (0, 1, "a", "x"), (0, 1, "a", "x"), (0, None, None, None), (0, None, None, None), (100, 1, "a", "x")]
    same(trie.prefix_trie(table(spark, rows)).collect(), brute(rows))
    tie = [(0, 1, "a", "x"), (0, 1, "b", "y"), (0, 1, "ab", "y")]
    found = [trie.prefix_trie(table(spark, t)).collect() for t in (tie, tie[::-1])]
    same(*found)


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(table(spark, []).limit(0)).collect() == []
    assert trie.prefix_trie(table(spark, [(None, 1, "a", "b")])).collect() == []
    short = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(short, 0, "user", "goes")]  # gives up its only turn, and there is no conversation to take others from
    assert brute(rows)[0][1:6] == (0, None, 1, 0, 1)
    same(trie.prefix_trie(table(spark, rows)).collect(), brute(rows))


def test_given_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = op12_conversation_trie(spark, SF_SMALL)
    same(found.collect(), brute(rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF_SMALL}/conversations.parquet'")
    sql = con.execute(ORACLE_SQL["op12_conversation_trie"])
    assert [c[0] for c in sql.description] == found.columns
    same(sql.fetchall(), brute(rows))
