import random
import zlib
from collections import Counter

import pytest

from mesura.llm import language_id as L

WORDS = {"en": "the and of to in that was with for his they this have from".split(), "de": "der die und das nicht ein ist sich auf für mit dem über schön".split(),
         "fr": "le la les des une est dans pour que qui avec été où français".split()}


def grams(text):
    out, word = Counter(), []
    clean = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not clean:
        return out
    s = " " + " ".join(clean) + " "
    out.update(c for c in s if c != " ")
    out.update(s[k:k + 2] for k in range(len(s) - 1))
    out.update(s[k:k + 3] for k in range(len(s) - 2))
    return out


def code(g):
    # word end before any letter, shorter before longer, as the integers are ordered
    return sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))


def top(counts, n):
    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:n]


def brute(rows, length):
    total = {}
    for i, text, lang in rows:
        if lang is not None and i is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            total.setdefault(lang, Counter()).update(grams(text))
    rank = {k: {g: r for r, g in enumerate(top(c, length))} for k, c in sorted(total.items()) if c}
    out = []
    for i, text, _ in rows:
        own = top(grams(text), length)
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not own or not rank:
            out.append((i, held, "und", 0.0))
            continue
        far = {k: sum(abs(r[g] - n) if g in r else length for n, g in enumerate(own)) for k, r in rank.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((i, held, best, 1 - far[best] / (length * len(own))))
    return out


def run(spark, rows, p=L.Params()):
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, lang string, score double, lang_pred string")
    return [tuple(r) for r in L.languages(df, p).collect()]


def test_against_brute_force_and_held_out(spark):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(5, 60))) + ".", lang) for k in range(200) for lang in [rng.choice(list(WORDS))]]
    odd = [(300, None, "en"), (301, "", "de"), (302, "123 !?", "en"), (303, "the cat", None), (None, "der und die", "de"), (5, "le la les", "fr"), (304, "日本語", None), (305, "Ünd " * 3000, "de"), (306, "a", "en")]
    for length in (400, 20):
        got, want = run(spark, rows + odd, L.Params(length=length)), brute(rows + odd, length)
        key = lambda r: (str(r[0]), r[2], r[3])
        assert [(a[:3], round(a[3], 9)) for a in sorted(got, key=key)] == [(b[:3], round(b[3], 9)) for b in sorted(want, key=key)]
    truth = {i: lang for i, _, lang in rows}
    held = [(i, p) for i, h, p, _ in run(spark, rows) if h]
    assert len(held) > 20 and sum(truth[i] == p for i, p in held) >= 0.97 * len(held)


def test_empty_table_and_no_language(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "abc", None)])[0][2:] == ("und", 0.0)


def test_sample_is_bounded(spark):
    rows = [(k, "the and of", "en") for k in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.fit(df, L.Params(rows=100)).names == ["en"]


def test_all_languages_are_learned(spark):
    # 1,500 languages, a letter pair each: none is left out, and too many are an error
    letters = [chr(0x4e00 + k) for k in range(1500)]
    rows = [(k * 4, f"{c}{c}{c}", f"l{k:04}") for k, c in enumerate(letters)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = L.fit(df)
    assert len(profiles.names) == 1500 and all(profiles.predict(f"{c}{c}")[0] == f"l{k:04}" for k, c in enumerate(letters))
    with pytest.raises(ValueError):
        L.fit(df, L.Params(languages=1499))
