import os
import zlib

import numpy as np
import pytest

from mesura.llm import packing as P
from mesura.llm.common import tokenizer_file


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))


TEXTS = [(1, "The cat, the dog."), (2, None), (3, ""), (4, "word " * 5000), (5, "İstanbul ſtraße ΣΑΣ don't it's 12ab <|endoftext|> <|ENDOFTEXT|>x"), (6, "日本語。\U0001f600 a\x1cb\x85c"),
         (7, "same text"), (8, "same text"), (7, "same text"), (None, "no id"), (9, "x" * 3000), (10, " \n\t"), (11, "!!! a,b. éÅ,."), (12, "one " * 4095), (13, "one " * 4096)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 5, 6) for i, t in rows], "doc_id long, text string, length int, rank int")


def check(rows, got, tokenizer, cap=P.Capacity()):
    want = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), cap.piece)):
            part = ids[a:a + cap.piece]
            want.append((i if i is not None else -1, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= cap.tokens and len(spans) <= cap.docs and sum(n * n for _, n in spans) <= cap.cost
    return bins


def test_pieces_and_places(spark, tokenizer):
    got = P.pack(table(spark, TEXTS)).collect()
    bins = check(TEXTS, got, tokenizer)
    assert len(bins) == -(-sum(r["length"] for r in got) // 4096)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_constraint_binds(spark, tokenizer, rule):
    rows = [(k, "word " * (k % 40)) for k in range(300)]
    for cap in (P.Capacity(64, 3, 64 * 64), P.Capacity(64, 64, 900), P.Capacity(50, 4, 1200)):
        check(rows, P.pack(table(spark, rows), cap, rule).collect(), tokenizer, cap)


def test_ids_and_empty_table(spark, tokenizer):
    got = P.pack(table(spark, [(1, "a b c")]), with_ids=True).first()
    assert got["ids"] == [*tokenizer.encode("a b c", add_special_tokens=False).ids, 1]
    empty = P.pack(table(spark, []))
    assert empty.count() == 0 and empty.columns[-2:] == ["sequence_id", "offset"]


def single_best_fit(lengths, size=4096):
    """Sequences that best fit, one piece at a time, takes."""
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [(r - n, k) for k, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits)[1]] -= n
        else:
            room.append(size - n)
    return len(room)


@pytest.mark.parametrize("top", [4096, 1500])
def test_slots_cover_every_rank_and_are_as_few_as_best_fit(top):
    rng = np.random.default_rng(2)
    counts = {int(k): int(n) for k, n in zip(rng.integers(1, top + 1, 120), rng.integers(1, 30, 120))}
    slots = P.best_fit(counts, P.Capacity())
    for length, n in counts.items():
        own = slots[slots[:, 0] == length]
        at = 0
        for _, rank, bins, copies, _, _ in own:
            assert rank == at
            at += bins * copies
        assert at == n
    used = max(s[4] + s[2] for s in slots)
    assert used <= single_best_fit([k for k, n in counts.items() for _ in range(n)]) + 1


def test_small_cache_gives_the_same_ids(tokenizer):
    file = tokenizer_file("word_bpe_49k.json")
    ids = P.ChunkIds(file, most=3)
    for _, t in TEXTS:
        got = b"".join(map(ids.__getitem__, (t or "").encode().split()))
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def test_ids_of_every_letter_before_marks(tokenizer):
    """A letter that normalisation splits must not lose its mark to the short way."""
    ids = P.ChunkIds(tokenizer_file("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x30000) if chr(c).isalpha()]
    wrong = []
    for start in range(0, len(letters), 20_000):
        runs = [x for c in letters[start:start + 20_000] for x in (c + "!", "a" + c + ").", c + "a,")]
        for run, want in zip(runs, tokenizer.encode_batch(runs, add_special_tokens=False)):
            if ids[run.encode()] != np.array(want.ids, "<u4").tobytes():
                wrong.append(run)
    assert wrong == []


def test_ids_of_mixed_scripts(tokenizer):
    import random
    ids, rng = P.ChunkIds(tokenizer_file("word_bpe_49k.json")), random.Random(2)
    signs = "aéßİıſ日本हिन्दीक़ড়য়ਲ਼ଢ଼שׁאּ한국́̃!?.,'\"-_()¿0९Ⅷ�ﬁ"
    runs = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(20_000)]
    assert [r for r, want in zip(runs, tokenizer.encode_batch(runs, add_special_tokens=False)) if ids[r.encode()] != np.array(want.ids, "<u4").tobytes()] == []


def test_repeated_and_null_ids_are_spread(spark, tokenizer):
    rows = [(None, "same text here")] * 900 + [(7, "same text here")] * 900 + [(k, "other text") for k in range(100)]
    bins = check(rows, P.pack(table(spark, rows), P.Capacity(64, 64, 64 * 64)).collect(), tokenizer, P.Capacity(64, 64, 64 * 64))
    assert sum(len(b) for b in bins.values()) == len(rows)
