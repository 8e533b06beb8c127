"""The conversation trie against a trie built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

TURN = "conv_id long, turn long, role string, text string"


def brute(rows):
    """{(conv_id, depth): the other columns} of rows (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    made = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        made[c] = turns.get(base, [])[:h] + turns[c][h:]
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    out, kids = {}, defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = sum(saved[k] for k in kids[s]) + (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0)
    for s, m in members.items():
        ends = ",".join(str(c) for c in m if len(made[c]) == len(s))
        parent = members[s[:-1]][0] if s else None
        out[m[0], len(s)] = (parent, len(m), len(kids[s]), leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest())
    return out


def found(df):
    rows = df.collect()
    got = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]) for r in rows}
    assert len(got) == len(rows)
    return got


def tricky(seed):
    """Long shared starts, parting inside and at the ends of blocks, copies, prefixes of one another, missing bases."""
    rng, rows = random.Random(seed), []
    paths = [[(rng.choice("ua"), f"t{rng.randrange(3)}é" * rng.randrange(1, 4)) for _ in range(30)] for _ in range(3)]
    for c in rng.sample(range(-20, 60), 55):
        path = list(rng.choice(paths)[: rng.choice([1, 3, 4, 5, 8, 9, 12, 17, 30])])
        if rng.random() < 0.5:
            path += [("u", f"own {rng.randrange(2)}")] * rng.randrange(3)
        order = list(range(len(path)))
        rows += [(c, t if rng.random() < 0.97 else None, *path[t]) for t in order]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, block, run", [(1, 4, 1024), (2, 4, 2), (3, 3, 1), (4, 1, 1024)])
def test_equals_the_trie_built_turn_by_turn(spark, seed, block, run):
    from kestrel.llm.conversation_trie import trie

    rows = tricky(seed)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURN + ", c long, rep string").repartition(5)
    assert found(trie(df, block, run)) == brute(rows)


def test_odd_rows(spark):
    from kestrel.llm.conversation_trie import NODES, trie

    rows = [(None, 0, "u", "lost"), (7, None, None, None), (7, None, "", ""), (7, 0, "u", "x" * 100_000), (7, 0, "u", "a"), (7, 0, "u", "a"),
            (8, 5, "u", None), (9, 1, None, "a"), (9, 1, None, "a"), (5, -1, "u", ""), (13, 3, "u", "only"), (2**62, 1, "u", "big")]
    assert found(trie(spark.createDataFrame(rows, TURN))) == brute(rows)
    one = [(3, 0, "u", "alone")]
    assert found(trie(spark.createDataFrame(one, TURN))) == brute(one)
    empty = trie(spark.createDataFrame([], TURN))
    assert empty.count() == 0 and empty.schema == spark.createDataFrame([], NODES).schema
    assert trie(spark.createDataFrame([(None, 1, "u", "x")], TURN)).count() == 0


def test_a_conversation_of_many_runs_and_a_shared_start(spark):
    """One conversation holds half of all turns, and a third of the others share their turns with it."""
    from kestrel.llm.conversation_trie import trie

    rows = [(0, t, "u", f"m{t % 7}") for t in range(900)] + [(c, t, "u", f"m{t % 7}" if c % 3 == 0 else f"{c}") for c in range(1, 60) for t in range(c % 17)]
    assert found(trie(spark.createDataFrame(rows, TURN), 4, 16)) == brute(rows)


def test_role_and_text_do_not_run_together(spark):
    from kestrel.llm.conversation_trie import trie

    rows = [(0, 0, "ab", "c"), (5, 0, "a", "bc"), (10, 0, "a", "bc"), (10, 1, "1:a", ""), (15, 0, "a", "bc"), (15, 1, "1", ":a")]
    assert found(trie(spark.createDataFrame(rows, TURN))) == brute(rows)


def test_query_equals_brute_force(spark):
    from kestrel.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_conversation_trie"](spark, sf)) == brute(rows)
