import itertools
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mesura.llm import sentence_pieces as S
from mesura.llm.common import mix64, tokenizer_file

P = S.Params()


@pytest.fixture(scope="module")
def sampler():
    return S.sampler(tokenizer_file(P.vocabulary), P)


TEXTS = ["the cat", "", " a  b\n\n▁x ▁▁", "日本 😀 ñé", "\x00\x01 \t\r\n", "x" * 2000, "word " * 4000, "<0x41> <s> </s> <unk>"]


def test_round_trip(sampler):
    ids = sampler.encode(TEXTS, np.arange(len(TEXTS), dtype=np.uint64))
    assert [sampler.pieces.decode(x) for x in ids] == TEXTS


@settings(max_examples=150, deadline=None)
@given(st.text(), st.integers(0, 2 ** 64 - 1))
def test_round_trip_of_any_text(text, key):
    s = S.sampler(tokenizer_file(P.vocabulary), P)
    (ids,) = s.encode([text], np.array([key], np.uint64))
    assert s.pieces.decode(ids) == text


def test_split_does_not_change_the_draws(sampler):
    small = S.Sampler(sampler.pieces, S.Params(most=3))
    texts = [t for t in TEXTS if len(t) < 1000]
    keys = np.arange(len(texts), dtype=np.uint64)
    for a, b in zip(sampler.encode(texts, keys), small.encode(texts, keys)):
        assert a.tolist() == b.tolist()


def paths(pieces, text, at=0):
    if at == len(text):
        return [((), 0.0)]
    names = {pieces.text[i]: i for i in range(len(pieces.text))}
    out = []
    for n in range(1, len(text) - at + 1):
        i = names.get(text[at:at + n], -1)
        if i >= 0 and not math.isnan(pieces.logp[i]):
            out += [((i, *p), pieces.logp[i] + w) for p, w in paths(pieces, text, at + n)]
    return out


@pytest.mark.parametrize("alpha", [1.0, 0.3])
def test_draws_follow_the_lattice(alpha):
    p = S.Params(alpha=alpha)
    pieces = S.Pieces(tokenizer_file(p.vocabulary), p)
    lattice = S.Lattices([" there", "cat"], pieces)
    n = 60000
    who, edge = lattice.sample(np.zeros(n, np.int64), mix64(np.arange(n, dtype=np.uint64)))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))])
    seen = Counter(tuple(lattice.piece[edge[a:b]]) for a, b in itertools.pairwise(bounds))
    brute = paths(pieces, S.SPACE + "there")
    total = sum(math.exp(w) for _, w in brute)
    assert set(seen) <= {x for x, _ in brute}
    for x, w in brute:
        share = math.exp(w) / total
        assert abs(seen[x] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4


def test_query_rows(spark):
    rows = [(1, "the cat sat", 0, "p"), (1, "the cat sat", 0, "p"), (2, None, 0, "p"), (None, "no id", 0, "p"), (3, "", 0, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_pieces int, pieces string")
    one, two = (sorted(map(tuple, S.encode(x).collect()), key=str) for x in (df, df.repartition(5)))
    assert one == two
    got = {(r["doc_id"], r["text"]) for r in S.decode(S.encode(df)).collect()}
    assert got == {(1, "the cat sat"), (2, None), (None, "no id"), (3, "")}
    other = S.encode(df, S.Params(seed=9, alpha=0.2)).filter("doc_id = 1").first()
    assert other["pieces"] != S.encode(df, S.Params(seed=10, alpha=0.2)).filter("doc_id = 1").first()["pieces"]
    assert S.decode(S.encode(df.limit(0))).count() == 0


def drawn(pieces, word, n):
    lattice = S.Lattices([word], pieces)
    who, edge = lattice.sample(np.zeros(n, np.int64), mix64(np.arange(n, dtype=np.uint64)))
    bounds = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=n))])
    return [tuple(lattice.piece[edge[a:b]].tolist()) for a, b in itertools.pairwise(bounds)]


def test_runs_of_spaces_have_their_pieces(sampler):
    pieces = sampler.pieces
    assert S.words_of("a    b  \n c ▁") == ["a", "    b", "  ", "\n", " c", " ", "▁"]
    n = 40000
    seen = Counter(drawn(pieces, "    b", n))
    brute = paths(pieces, S.SPACE * 4 + "b")
    total = sum(math.exp(w) for _, w in brute)
    assert any(set(pieces.text[x[0]]) == {S.SPACE} and len(pieces.text[x[0]]) > 1 for x in seen)
    for x, w in brute:
        share = math.exp(w) / total
        assert abs(seen[x] / n - share) < 5 * math.sqrt(share / n) + 1e-3


def test_a_long_run_is_not_cut(sampler):
    """The share of draws with a boundary at each of some places is that of
    forward and backward sums over the whole run."""
    pieces, run = sampler.pieces, "thequickbrownfoxjumps" * 30
    names = {t: i for i, t in enumerate(pieces.text) if not math.isnan(pieces.logp[i])}
    size = len(run)
    edges = [[(b, pieces.logp[names[run[a:b]]]) for b in range(a + 1, min(size, a + pieces.longest) + 1) if run[a:b] in names] for a in range(size)]
    ahead, behind = [-math.inf] * size + [0.0], [0.0] + [-math.inf] * size
    for a in reversed(range(size)):
        ahead[a] = float(np.logaddexp.reduce([w + ahead[b] for b, w in edges[a]]))
    for a in range(size):
        for b, w in edges[a]:
            behind[b] = float(np.logaddexp(behind[b], behind[a] + w))
    n, cut = 3000, Counter()
    for x in drawn(pieces, run, n):
        cut.update(itertools.accumulate(len(pieces.text[i]) for i in x))
    assert cut[size] == n
    for at in (1, 256, 511, 512, 513, 600):
        share = math.exp(behind[at] + ahead[at] - ahead[0])
        assert abs(cut[at] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3, at
