import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mesura.llm import lm_score as L

SCHEMA = "doc_id long, text string, row string, batch int, range int"


def trained(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 != 0


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), ("end",)]


def brute(rows, p):
    """Scores from counted n-grams by the smoothing's recursion, word by word."""
    begin, count = ("begin",), Counter()
    texts = [(i, [begin, *tokens(t)]) for i, t in rows]
    for i, s in texts:
        if trained(i):
            count[begin,] += 1
            for k in range(1, p.order + 1):
                count.update(tuple(s[j - k + 1:j + 1]) for j in range(max(1, k - 1), len(s)))
    words = {g: n for g, n in count.items() if len(g) == 1 and g != (begin,)}
    n, v = sum(words.values()), len(words)
    out = []
    for i, s in texts:
        base = score = 0.0
        for j in range(1, len(s)):
            chance = (words.get((s[j],), 0) + p.add) / (n + p.add * (v + 1))
            base += math.log10(chance)
            for k in range(1, min(j + 1, p.order)):
                h = tuple(s[j - k:j])
                if count[h]:
                    chance = (count[*h, s[j]] + p.strength * chance) / (count[h] + p.strength)
            score += math.log10(chance)
        out.append((i, i is not None and not trained(i), len(s) - 1, sum((w,) in words for w in s[1:]), n, base, score))
    return sorted(out, key=str)


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-9, abs_tol=1e-9)


def run(spark, rows, p):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in L.lm_scores(df, p).collect()), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = "a b C d e f The the THE x.y ¿qué? 漢字 ﬁ".split()
    text = lambda: "".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\t", "  "]) for _ in range(rng.choice([0, 1, 3, 30])))
    rows = [(k, text()) for k in range(n)]
    rows += [rows[5]] * 4 + [(k, rows[7][1]) for k in range(500, 540)] + [(600, None), (601, ""), (602, " \n"), (None, "a b a b"), (None, None), (-3, "a the b")]
    return rows + [(700, "a b c " * 700), (703, "never seen words " * 300)]


@pytest.mark.parametrize("p", [L.Params(), L.Params(order=1, batch=100), L.Params(order=3, batch=257, answer=50, lane=5), L.Params(order=4, batch=64, answer=100, lane=1, strength=0.5)])
def test_against_brute_force(spark, p):
    rows = corpus(1)
    same(run(spark, rows, p), brute(rows, p))


def test_probabilities_after_any_state_add_up():
    p = L.Params(order=3)
    gather = L._Gather(p, 0)
    for k, t in enumerate(["a b a c", "a b b", "b a b a", "c"]):
        assert not list(gather.add(t, k, True))
    grams = L.Grams.of(gather.give(), p.order)
    counts = np.split(grams.trained(), np.cumsum([len(k) for k in grams.keys])[:-1])
    known = int((counts[0] > 0).sum())
    machine = L.Automaton(grams, counts, L.Totals(int(counts[0].sum()), known, 4), p)
    unseen = p.add / (counts[0].sum() + p.add * (known + 1))
    words = np.flatnonzero(counts[0] > 0)
    end = int(np.flatnonzero(grams.keys[0] == np.uint64(L.END & ~1))[0])
    first, _ = machine.step(np.zeros(1, np.int64), np.array([grams.begin]))
    met, todo = set(), [0, int(first[0])]
    while todo:
        state = todo.pop()
        met.add(state)
        goal, score = machine.step(np.full(len(words), state), words)
        todo += set(goal[words != end].tolist()) - met
        fall, at = 1.0, state  # what is left for an unseen word, along the failure arcs
        while at:
            fall, at = fall * 10 ** machine.fall[at], machine.fail[at]
        assert math.isclose((10 ** score).sum() + fall * unseen, 1.0, rel_tol=1e-9)
    assert len(met) > 8


def test_no_training_rows_and_empty_table(spark):
    held = [k for k in range(200) if not trained(k)]
    rows = [(k, "a b") for k in held]
    got = run(spark, rows, L.Params())
    assert got == [(k, True, 3, 0, 0, 0.0, 0.0) for k in sorted(held, key=lambda k: str((k,)))]
    assert run(spark, [], L.Params()) == []


def test_longer_contexts_help_held_out_texts(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choice(["one two three", "two one four", "three five"]) for _ in range(20))
    got = [r for r in run(spark, [(k, text()) for k in range(300)], L.Params()) if r[1]]
    assert got and all(r[6] > r[5] for r in got)
