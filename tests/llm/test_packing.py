import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from gatewatch.llm import packing as p
from gatewatch.llm import tokens
from gatewatch.llm.common import table

TEXTS = ["", "a", "It's we'll  I'd\t\tx \n\n y ", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "1234²³¼ x½y", "ÀÉß ñandú über", "日本語 text",
         "a b c", "x\x1c\x1dy", "emoji 😀 ok", "don't DON'T 'S", "   lead", "tail   ", "\x85\x85a", "mixed中a é１２", "a" * 500, "'", " '", "!? ...", "ɏɐ"]


@pytest.fixture(scope="module")
def official():
    return Tokenizer.from_file(p.TOKENIZER)


def test_ids_equal_the_library(spark, official):
    own = tokens.TokenIds(p.TOKENIZER)
    texts = TEXTS + [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    for _ in range(2):  # without and with cached words
        for t in texts:
            assert np.frombuffer(own(t), "<u4").tolist() == official.encode(t, add_special_tokens=False).ids, t[:50]


def check(rows, docs, official, capacity):
    want = {}
    for i, t in docs:
        ids = official.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = p.cut_pieces(len(ids), capacity)
        assert len(pieces) == -(-len(ids) // capacity) and all(n == capacity for _, n in pieces[1:])
        for k, (s, n) in enumerate(pieces):
            key = (i, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes()))
            want[key] = want.get(key, 0) + 1
    got = {}
    bins = {}
    for r in rows:
        key = (r.id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == want
    for spans in bins.values():
        spans.sort()
        at = 0
        for offset, length in spans:
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("deme_size", [20, 4000])
def test_packs_every_piece_once(spark, official, deme_size):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = p.pack_documents(docs, deme_size=deme_size).collect()
    n = check(rows, [(d.doc_id, d.text) for d in docs.collect()], official, 2048)
    lengths = np.array([r.length for r in rows])
    bound = int((lengths == 2048).sum()) + p.lower_bound(lengths[lengths < 2048], 2048)
    assert n <= bound * (1.15 if deme_size == 20 else 1.0) + 1


def test_odd_rows(spark, official):
    docs = [(1, None), (2, ""), (None, "x y"), (3, "word " * 30_000), (4, "same"), (4, "same")] + [(i + 10, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame([(i, t, 5, "k") for i, t in docs], "doc_id long, text string, item int, piece string")
    check(p.pack_documents(df, capacity=64, deme_size=8).collect(), docs, official, 64)
    assert p.pack_documents(df.limit(0)).count() == 0
    ids = p.pack_documents(df, with_ids=True).where("id = 4").first().ids
    assert ids == official.encode("same", add_special_tokens=False).ids + [0]


def test_evolution_beats_or_equals_best_fit_decreasing():
    rng = np.random.default_rng(0)
    for seed in range(6):
        lengths = rng.integers(300, 1200, 120)
        order = np.argsort(-lengths, kind="stable").tolist()
        bins, room = [], []
        p.best_fit(bins, room, order, lengths.tolist(), 2048)
        start = p.evolve(lengths, 2048, 0, [], generations=0)
        best = p.evolve(lengths, 2048, seed, [start], generations=30)
        used = np.bincount(best, lengths)
        assert used.max() <= 2048 and p.lower_bound(lengths, 2048) <= len(used) <= len(bins)


def test_injected_bins_stay_whole():
    lengths = np.array([1024] * 8 + [700, 700, 648])
    best = p.evolve(lengths, 2048, 3, [], 10)
    assert len(set(best.tolist())) == 5 == p.lower_bound(lengths, 2048)
