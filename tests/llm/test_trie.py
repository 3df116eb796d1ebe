"""The tree of prefixes against one made of dictionaries."""

import hashlib
import random
import re
import zlib

import pytest

from orderstrata.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def _brute(convs):
    """A row for each node, of conversations as tuples of (role, text)."""
    members, ends = {}, {}
    for conv_id, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv_id)
        ends.setdefault(turns, []).append(conv_id)
    children = {node: 0 for node in members}
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = {node: 0 for node in members}, {node: 0 for node in members}
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(
        (
            (
                min(m),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(m),
                children[node],
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
            for node, m in members.items()
        ),
        key=repr,
    )


def _ordered(rows):
    convs = {}
    for conv_id, turn, role, text in sorted(
        (r for r in rows if r[0] is not None),
        key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", _mark(r[2] or "", r[3] or "")),
    ):
        convs[conv_id] = (*convs.get(conv_id, ()), (role or "", text or ""))
    return convs


def _mark(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def _rebuilt(convs):
    out = {}
    for c, turns in convs.items():
        head = c - (abs(c) % 20) * (1 if c > 0 else -1)
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(head, ())[:h] + turns[h:]
    return out


def _rows(seed):
    rng = random.Random(seed)
    texts = ["", "one", "two words", "a\tb\nc  d", "é x y"]
    rows = []
    for c in range(60):
        for turn in range(rng.choice([1, 1, 2, 3, 4, 5, 8, 9])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", rng.choice(texts[:3])))
    for c in (77, 91, 92, 2**60):  # no head, long, equal to one another
        rows += [(c, turn, "user", texts[turn % 5]) for turn in range(45 if c > 90 else 2)]
    rows += [(-21, k, "system", "neg") for k in range(3)] + [(-20, 0, "system", "neg")]
    rows += [(95, 0, None, None), (95, None, "user", "first"), (95, 0, "", None), (95, 3, "user", "x" * 300_000)]
    rows += [(96, 1, "user", "again")] * 3 + [(97, 1, "b", "t"), (97, 1, "a", "u"), (97, 1, "a", "v")]
    rows += [(c, 0, "user", "alone") for c in range(101, 106)]  # some lose their only turn
    rows += [(None, 0, "user", "of none")]
    return rows


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]


@pytest.mark.parametrize("columns", [1, 2, 4])
def test_tree(spark, columns):
    rows = _rows(columns)
    table = spark.createDataFrame([(*r, 0, b"") for r in rows], f"{SCHEMA}, place int, mark binary")
    tree = trie.prefix_tree(trie.turn_marks(table), columns=columns)
    assert tree.columns == COLUMNS
    assert _found(tree) == _brute(_ordered(rows))


def test_query_rebuilds(spark, tmp_path):
    rows = _rows(9)
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    found = _found(queries.op11_prefix_trie(spark, str(tmp_path)))
    rebuilt = _rebuilt(_ordered(rows))
    assert () in rebuilt.values(), "one without turns"
    assert found == _brute(rebuilt)


def test_many_ends(spark):
    """More conversations end at one node than are joined in one row."""
    many = spark.range(-700, 2500).selectExpr("id AS conv_id", "0L AS turn", "'user' AS role", "'hi' AS text")
    found = _found(trie.prefix_tree(trie.turn_marks(many)))
    assert found == _brute({c: (("user", "hi"),) for c in range(-700, 2500)})


def test_no_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_tree(trie.turn_marks(none)).collect() == []
    only = spark.createDataFrame([(3, None, None, None)], "conv_id long, place int, mark binary, words long")
    assert _found(trie.prefix_tree(only)) == _brute({3: ()})


def test_prefixes_are_rolled_up(spark):
    table = spark.createDataFrame(_rows(1), SCHEMA)
    seen = []
    sql = spark.sql
    try:
        spark.sql = lambda text, **frames: (seen.append(text), sql(text, **frames))[1]
        trie.prefix_tree(trie.turn_marks(table))
    finally:
        del spark.sql
    assert len(seen) == 2 and all("ROLLUP (t1, t2, t3, t4)" in s and "grouping_id()" in s for s in seen)
