from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from acquaint.llm import tokens
from acquaint.llm.packing import Packing, longest_piece, pack_documents, place
from acquaint.llm.queries import tokenizer_path
from acquaint.llm.tokens import PieceTokenizer
from tests.llm.data import documents, hard_rows, prose


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def ids(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [1]


def test_pieces_are_the_documents(spark, plain):
    rows = hard_rows()
    found = pack_documents(documents(spark, rows), tokenizer_path(), Packing(length=64)).collect()
    wanted = defaultdict(list)
    for doc_id, text, *_ in rows:
        wanted[doc_id].append(ids(plain, text))
    covered = defaultdict(int)
    for r in found:
        fits = [
            t for t in wanted[r.doc_id]
            if len(t) == r.doc_tokens
            and zlib.crc32(np.array(t[r.start : r.start + r.length], "<u4")) == r.ids_crc32
        ]
        assert fits, r
        covered[r.doc_id] += r.length
    assert covered == {d: sum(map(len, t)) for d, t in wanted.items()}
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length, r.padded_length))
    for pieces in sequences.values():
        at = 0
        for offset, length, padded in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64 and (padded == 64 or padded == at)


def test_empty_table(spark):
    assert pack_documents(documents(spark, []), tokenizer_path()).collect() == []


def plain_place(lengths, packing, cut):
    """The same assignment with plain lists: descending pieces, cheapest with room."""
    pieces = [(d, s, min(cut, n - s)) for d, n in enumerate(lengths) for s in range(0, n, cut)]
    pieces.sort(key=lambda p: -p[2])
    room = [packing.length] * -(-sum(lengths) // packing.length)
    cost = [0.0] * len(room)
    put, left = [], []

    def add(d, s, n, at):
        put.append((d, s, n, at, packing.length - room[at]))
        room[at] -= n
        cost[at] += packing.linear * n + packing.quadratic * n * n

    for d, s, n in pieces:
        fitting = [k for k in range(len(room)) if room[k] >= n]
        if fitting:
            add(d, s, n, min(fitting, key=lambda k: (cost[k], k)))
        else:
            left.append((d, s, n))
    gaps = sorted(range(len(room)), key=lambda k: -room[k])
    for d, s, n in left:
        while n:
            at = gaps[0]
            take = min(n, room[at])
            if take:
                add(d, s, take, at)
                s, n = s + take, n - take
            if not room[at]:
                gaps.pop(0)
    return put, cost


@pytest.mark.parametrize("seed", range(5))
def test_pieces_go_to_the_cheapest_sequence_with_room(seed):
    draw = np.random.default_rng(seed)
    lengths = draw.integers(1, 3000, 200)
    packing = Packing(length=512, least_cut=64, quadratic=1 / 256)
    *columns, sequences = place(lengths, packing)
    document, start, length, sequence, _ = columns
    cut = longest_piece(lengths, packing)
    put, cost = plain_place(lengths.tolist(), packing, cut)
    assert list(zip(*(c.tolist() for c in columns))) == put
    covered = np.bincount(document, weights=length, minlength=200)
    assert (covered == lengths).all()
    assert sequences == -(-int(lengths.sum()) // 512)
    filled = np.bincount(sequence, weights=length, minlength=sequences)
    assert filled.max() <= 512 and sequences * 512 - filled.sum() < 512
    for d in range(200):
        mine = sorted(zip(start[document == d], length[document == d]))
        assert [s for s, _ in mine] == list(np.cumsum([0, *[n for _, n in mine]])[:-1])


def test_cuts_of_long_documents_level_costs():
    draw = np.random.default_rng(1)
    lengths = np.concatenate((draw.integers(20, 400, 600), draw.integers(3000, 9000, 20)))
    packing = Packing()
    assert longest_piece(lengths, packing) < packing.length

    def spread(cut):
        _, cost = plain_place(lengths.tolist(), packing, cut)
        return np.std(cost) / np.mean(cost)

    *_, length, sequence, _, sequences = place(lengths, packing)
    cost = np.bincount(sequence, weights=packing.cost(length), minlength=sequences)
    assert np.std(cost) / np.mean(cost) < spread(packing.length) / 2


def test_documents_that_are_all_long_stay_in_whole_sequences():
    lengths = np.full(40, 2048 * 9 + 1800)
    assert longest_piece(lengths, Packing()) == 2048
    assert longest_piece(np.zeros(0, np.int64), Packing()) >= 256
    assert [len(c) for c in place(np.zeros(0, np.int64), Packing())[:5]] == [0] * 5


def test_short_documents_share_sequences_evenly():
    _, _, length, sequence, _, sequences = place(np.full(40, 100), Packing(length=1000))
    cost = np.bincount(sequence, weights=length, minlength=sequences)
    assert sequences == 4 and set(cost) == {1000.0}


def test_long_texts_are_encoded_in_segments(plain, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", 50)
    text = prose(4, 300) + "  two  spaces \n\n and " + "x" * 120 + " end "
    found = PieceTokenizer(tokenizer_path()).encode_long([text, "", "short", text[:50]])
    assert [f.tolist() for f in found] == [ids(plain, t)[:-1] for t in (text, "", "short", text[:50])]


def test_few_characters_are_remembered(plain, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_CHARACTERS", 3000)
    tokenizer = PieceTokenizer(tokenizer_path())
    for seed in range(5):
        texts = ["y" * (2000 + seed), prose(seed, 30), "z" * 10]
        assert [f.tolist() for f in tokenizer.encode(texts)] == [ids(plain, t)[:-1] for t in texts]
        assert sum(map(len, tokenizer._numbers)) < 7000


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "a", " a", "a ", "a  b", "a \n b", "it's 12 o'clock, isn't it?\n\n x",
        " a   b", "tab\t x", "<|endoftext|> x<|endoftext|>y", "\x1c \x1d a",
        "　你好 世界", "\U0001f600 \U0001f601", "a\r\n b \r\n c",
    ],
)
def test_remembered_pieces_give_the_ids_of_the_whole(plain, text):
    tokenizer = PieceTokenizer(tokenizer_path())
    texts = [text, prose(3, 50), text, "x" + text + "y z", text + " end"]
    found = tokenizer.encode(texts)
    assert [f.tolist() for f in found] == [ids(plain, t)[:-1] for t in texts]


def test_forgetting_changes_nothing(plain, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PIECES", 40)
    tokenizer = PieceTokenizer(tokenizer_path())
    for seed in range(30):
        texts = [prose(seed, 25, 60), "the same piece", prose(seed % 3, 9)]
        assert [f.tolist() for f in tokenizer.encode(texts)] == [ids(plain, t)[:-1] for t in texts]
    assert len(tokenizer._numbers) < 200
