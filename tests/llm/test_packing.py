import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabspark.llm import packing
from tabspark.llm.q_packing import tokenizer_path

ODD = ["  a  b \n c\n\n d\t e ", "x \n y", " lead", "trail ", "a\x1c b", "it's  don't 's", "", " ", "   ", "a\r\n b",
       "<|endoftext|> a", "one,\ntwo.\nthree!! (four) 5%"]


def fresh_ids(texts):
    """By the contract's tokenizer alone, nothing of it changed."""
    from tokenizers import Tokenizer

    return [np.array(x.ids, "<u4").tobytes()
            for x in Tokenizer.from_file(tokenizer_path()).encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer():
    e = packing.Encoder(tokenizer_path())
    rng = random.Random(1)
    bits = ["a", " ", "\n", "b", "'s", "1", ".", ",", "\x1c", "\t", "é", "\u3000", "\u00a0", "\u0085", "\u2028", "\r", "\x00",
            "<|endoftext|>", "|", ">", "中", "\u200b", "\U0001F926", " word", "it's", " (x)", "!?", "\x7f", "\x0b"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(20_000)]
    want = fresh_ids(texts)
    assert e.encode(texts) == want
    assert e.encode(texts[::-1]) == want[::-1]
    assert packing.Encoder(tokenizer_path()).encode([None, "", "é"]) == [b"", b"", fresh_ids(["é"])[0]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 6000), max_size=40))
def test_groups_are_full_and_whole(lengths):
    seen = {}
    for size, pieces in packing.pack_group(lengths, 2048):
        assert size & (size - 1) == 0 and size <= 2048 and sum(n for _, _, n in pieces) == size
        for d, at, n in pieces:
            seen.setdefault(d, []).append((at, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, m in sorted(seen.get(d, [])):
            assert start == at and m > 0
            at += m
        assert at == n


def test_steps_are_balanced():
    sizes = [2048] * 100 + [256] * 77
    steps = packing.step_of(sizes, 16_384)
    load = np.bincount(steps, weights=sizes)
    assert load.max() - load.min() <= 2048


def test_pieces(spark, make_docs):
    rng = random.Random(3)
    texts = [None, "", "short", "short", "word " * 40_000, *ODD,
             *["".join(rng.choice(["stone ", "é", "river, "]) for _ in range(rng.randint(0, 900))) for _ in range(60)]]
    docs = make_docs(texts + [(None, "no id"), (7, "again " * 33)], extra=True)
    rows = packing.pack(docs, tokenizer_path(), group_tokens=8000, keep_ids=True).collect()
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    want = sorted(np.append(np.frombuffer(b, "<u4"), 1).tolist()
                  for b in fresh_ids([r.text or "" for r in docs.collect()]))
    # Rows of one id may share pieces' ids, so documents are told apart by id and number of tokens.
    parts = {}
    for r in rows:
        parts.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    got = []
    for (_, n), own in parts.items():
        own.sort(key=lambda r: r.start)
        assert sum(r.length for r in own) % n == 0
        if sum(r.length for r in own) == n:
            got.append(np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist())
    assert sorted(got) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.context))
    for own in sequences.values():
        at = 0
        for offset, n, _ in sorted(own):
            assert offset == at
            at += n
        assert at == own[0][2]


def test_empty_table(make_docs):
    assert packing.pack(make_docs([]), tokenizer_path()).count() == 0
