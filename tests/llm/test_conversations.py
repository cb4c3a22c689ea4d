"""The prefix trie against one of plain dictionaries, and the radix tree beneath it."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from acquaint.llm import conversations, radix
from acquaint.llm.conversations import prefix_nodes, rebuilt, sequences

#: Columns of conversations, and names that the operator uses inside.
COLUMNS = (
    "conv_id long, turn long, role string, text string, id string, turns string, path string,"
    " chunk string, key string, part string, number string, words string, family string"
)


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 9) for r in rows], COLUMNS)


def found(frame) -> list[tuple]:
    return sorted(map(tuple, prefix_nodes(rebuilt(sequences(frame))).collect()), key=str)


def plain(rows: list[tuple]) -> list[tuple]:
    """The same nodes from dictionaries of whole sequences."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    nodes, children = defaultdict(list), defaultdict(list)
    for conv_id in turns:
        h = zlib.crc32(str(conv_id).encode()) % 4
        # The remainder has the sign of the id, as in SQL.
        base = sorted(turns.get(conv_id - abs(conv_id) % 20 * (1 if conv_id > 0 else -1), []))
        whole = tuple(x[2:] for x in base[:h] + sorted(turns[conv_id])[h:])
        for depth in range(len(whole) + 1):
            nodes[whole[:depth]].append((conv_id, len(whole)))
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    done: dict = {}
    for node in sorted(nodes, key=len, reverse=True):
        members, below = nodes[node], children[node]
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        ends = sorted(c for c, n in members if n == len(node))
        done[node] = (
            min(members)[0],
            len(node),
            min(nodes[node[:-1]])[0] if node else None,
            len(members),
            len(below),
            sum(done[b][5] for b in below) or 1,
            (len(members) - 1) * words + sum(done[b][6] for b in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return sorted(done.values(), key=str)


def branching(seed: int, conversations_: int, most: int, turns: int) -> list[tuple]:
    """Conversations of few different turns, so that they share many beginnings."""
    draw = random.Random(seed)
    rows = []
    for conv_id in range(conversations_):
        for turn in range(draw.randint(1, most)):
            text = " ".join(["word"] * draw.randint(0, turns))
            rows.append((conv_id, turn, draw.choice(["user", "assistant"]), text))
    return rows


@pytest.mark.parametrize("portion", [1, 300, 1_000_000])
def test_nodes_are_those_of_plain_dictionaries(spark, portion, monkeypatch):
    monkeypatch.setattr(conversations, "PORTION_BYTES", portion)
    rows = branching(1, 150, 9, 3)
    assert found(table(spark, rows)) == plain(rows)


def test_hard_rows(spark):
    rows = [
        (0, None, "user", "null turn comes first"),
        (0, 5, None, None),
        (0, 5, "user", "a tie"),
        (0, 5, "user", "a tie"),
        (3, 0, "user", " \t\n"),
        (3, 1, "user", ""),
        (23, 0, "user", "no base: what h turns it loses is not replaced"),
        (-21, 0, "user", "negative"),
        (None, 0, "user", "belongs to none"),
        (40, 0, "user", "long " * 100_000),
        (41, 0, "user", "éè \U0001f600"),
        (41, 1, "us", "er"),
        (42, 0, "us", "er"),
        (42, 1, "user", ""),
    ]
    assert found(table(spark, rows)) == plain(rows)


def test_conversations_without_turns_are_members_of_the_root(spark):
    # Without its base, a conversation of at most h turns keeps none.
    short = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4)
    rows = [(short, 0, "user", "a b")]
    assert found(table(spark, rows)) == plain(rows)
    ((conv_id, depth, parent, n, *_),) = found(table(spark, rows))
    assert (conv_id, depth, parent, n) == (short, 0, None, 1)


def test_no_conversations(spark):
    assert found(table(spark, [])) == []
    assert found(table(spark, [(None, 0, "user", "a")])) == []


def test_a_large_group_of_copies_and_a_common_first_turn(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PORTION_BYTES", 2000)
    rows = [(c, t, "user", f"copied {t}") for c in range(0, 12_000, 20) for t in range(3)]
    rows += [(c, t, "user", "copied 0" if t == 0 else f"{c} {t}") for c in range(1, 3000, 20) for t in range(4)]
    assert found(table(spark, rows)) == plain(rows)


def test_portions_split_the_subtree_of_one_turn(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PORTION_BYTES", 2000)
    rows = [(c * 20, t, "user", "same" if t == 0 else f"{c} {t}") for c in range(400) for t in range(3)]
    whole = rebuilt(sequences(table(spark, rows)))
    portions = conversations._portions(conversations._paths(whole)).collect()
    assert len(portions) > 8
    assert max(len(p["paths"]) for p in portions) < 2200


def test_a_conversation_of_many_turns(spark):
    rows = [(c, t, "user", f"{t % 7} word") for c in (20, 40) for t in range(5000 - c)]
    nodes = found(table(spark, rows))
    assert len(nodes) == 4981
    (deepest,) = [n for n in nodes if n[1] == 4980]
    assert deepest[:6] == (20, 4980, 20, 1, 0, 1)


def test_layouts_grow_with_their_children():
    tree = radix.RadixTree()
    kinds = []
    for n in range(256):
        tree.put(bytes([n, 1, 2]), n)
        kinds.append(type(tree.root.layout).__name__)
    assert [kinds.index(k) + 1 for k in dict.fromkeys(kinds)] == [1, 5, 17, 49]
    assert [x.value for x in tree.root.in_order()] == list(range(256))
    assert all(tree.get(bytes([n, 1, 2])) == n for n in range(256))


def test_paths_are_compressed():
    tree = radix.RadixTree()
    tree.put(b"conversation-a", 1)
    tree.put(b"conversation-b", 2)
    tree.put(b"conv", 3)
    (node,) = tree.root.in_order()
    assert (node.prefix, node.value) == (b"onv", 3)
    (below,) = node.in_order()
    assert below.prefix == b"rsation-"
    assert [x.prefix for x in below.in_order()] == [b"", b""]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(max_size=6).map(lambda b: bytes(x % 5 for x in b)), st.integers(0, 99)))
def test_tree_holds_what_was_put(values):
    tree = radix.RadixTree()
    for key, value in values.items():
        tree.put(key, value)
    assert all(tree.get(key) == value for key, value in values.items())
    assert tree.get(b"\x09") is None
    seen = [s.node.value for s in conversations._upwards(tree.root) if s.node.value is not None]
    assert sorted(seen) == sorted(values.values())
