"""The conversation trie against plain Python, and the radix tree against sorted keys."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import prefixes
from millrace.llm.prefixes import prefix_trie
from millrace.llm.radix import Tree

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def _name(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = (role or "", text or "")
            own[conv].append((turn is not None, turn or 0, _name(*said), said))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    found = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        saved = sum((len(members[q]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        leaves = sum(1 for q in below if not children[q])
        found.append((min(convs), len(p), parent, len(convs), children[p], leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def trie(spark, rows):
    frame = prefix_trie(spark.createDataFrame(rows, SCHEMA))
    assert frame.columns == NAMES and {t for n, t in frame.dtypes if n != "ends_sha256"} == {"bigint"}
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def _talk(seed, convs, longest, kinds):
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for turn in range(draw.randrange(1, longest)):
            text = draw.choice(["a b", "c", "", None, "d  e\nf"][:kinds])
            rows.append((c, turn, draw.choice(["user", None]) if seed % 2 else "user", text))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_trie_is_that_of_plain_python(spark, seed):
    rows = _talk(seed, 60, 9, 2 + seed)
    assert trie(spark, rows) == plain(rows)


def test_long_conversations_span_pieces_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE", 4)
    monkeypatch.setattr(prefixes, "KEYS", 3)
    rows = _talk(4, 25, 30, 2)
    rows += [(c, None if t < 3 else t, "user", "a b") for c in (25, 26, 47) for t in range(70)]
    assert trie(spark, rows) == plain(rows)


def test_one_beginning_and_one_conversation_hold_most_rows(spark):
    rows = [(c, t, "system" if t == 0 else "user", "same words" if t < 3 else f"own {c % 7}") for c in range(150) for t in range(3 + c % 3)]
    rows += [(1000, t % 50, "user", "x") for t in range(400)]
    assert trie(spark, rows) == plain(rows)


def test_odd_conversations(spark):
    rows = [
        (None, 1, "user", "nobody"), (0, None, None, None), (0, None, "user", "a"), (0, None, "user", "a"), (3, 5, "", ""),
        (-7, 1, "user", "minus"), (-20, 1, "user", "base"), (-20, 0, "user", "first"), (9, 1, "user", "w " * 5000), (41, 1, "x", "y"),
    ]
    wanted = [(c, t, r, x) for c, t, r, x in rows if c is None or c >= 0]
    assert trie(spark, wanted) == plain(wanted)
    assert len(trie(spark, rows)) > len(trie(spark, wanted))
    assert trie(spark, []) == []
    clash = spark.createDataFrame([(1, 1, "user", "a", 7, 8)], SCHEMA + ", depth int, conv int")
    assert prefix_trie(clash).count() == 1 + len(plain([(1, 1, "user", "a")])) - 1


def test_a_conversation_without_turns_of_its_own_ends_at_the_root(spark):
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 2)
    rows = [(short, 1, "user", "left out")]
    digest = hashlib.sha256(str(short).encode()).hexdigest()
    assert trie(spark, rows) == [(short, 0, None, 1, 0, 1, 0, digest)]


def test_radix_tree_holds_all_keys_and_grows():
    draw = random.Random(5)
    keys = [bytes(draw.choices(range(256), k=draw.randrange(0, 4))) for _ in range(3000)]
    keys += [b"\x01" * n for n in range(40)] + [bytes([n]) + b"tail" * 9 for n in range(256)] + [b"zz" + bytes([n]) for n in range(30)]
    tree = Tree()
    for key in keys:
        place = tree.insert(key)
        place[:] = [(place[0] if place else 0) + 1]
    wanted = Counter(keys)
    assert tree.keys == len(wanted)
    found = {}
    open_nodes = [(tree.root, b"")]
    sizes = set()
    while open_nodes:
        node, before = open_nodes.pop()
        at = before + node.path
        sizes.add(node.size)
        assert [b for b, _ in node.pairs()] == sorted(b for b, _ in node.pairs())
        assert node.end is not None or len(list(node.pairs())) > 1  # else the path is not compressed
        assert node.size in (4, 16, 48, 256) and len(list(node.pairs())) <= node.size
        if node.end is not None:
            found[at] = node.end[0]
        for byte, kid in node.pairs():
            assert node.child(byte) is kid
            open_nodes.append((kid, at + bytes([byte])))
    assert found == wanted and sizes == {4, 16, 48, 256}
