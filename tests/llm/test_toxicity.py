import random
import zlib

import numpy as np
import pytest

from mesura.llm import toxicity as X

FINE = "the river runs under a bridge while people walk home after morning work in gardens near windows and tables".split()
BAD = ["loser", "moron", "scum"]


def corpus(rng, n=400):
    rows, labels = [], []
    for k in range(n):
        words = [rng.choice(FINE) for _ in range(rng.randrange(10, 40))]
        y = int(rng.random() < 0.25)
        if y:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((k, " ".join(words)))
        labels.append((k, y))
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame([(*r, 9.0, 3) for r in rows], "doc_id long, text string, score double, predicted int"),
            spark.createDataFrame([(*r, "q") for r in labels], "doc_id long, toxic int, text string"))


def test_held_out_accuracy_and_disguises(spark):
    rng = random.Random(8)
    rows, labels = corpus(rng)
    truth = dict(labels)
    tricks = ["l0ser", "l o s e r", "l.o.s.e.r", "lo$er", "m0r0n", "mo-ron", "looooser", "LOSER!!", "$cum", "s*c*u*m", "5cum"]
    odd = [(1000 + k, f"the people walk {t} under a bridge") for k, t in enumerate(tricks)]
    fine = [(2000 + k, " ".join(random.Random(k).choice(FINE) for _ in range(30))) for k in range(60)] + [(2100, "2 b 4 c 100% $5 a.m. e-mail x y z w v u"), (2101, "colser scumble")]
    edge = [(3000, None), (3001, ""), (None, "moron moron"), (3002, "loser " * 20000), (7, "the river")]
    got = X.toxic_scores(*frames(spark, rows + odd + fine + edge, labels + [(None, 1), (5000, None), (5001, 1)])).collect()
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 7}
    assert len(got) == len(rows + odd + fine + edge)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in by.items() if i is not None)
    held = [i for i in truth if i != 7 and by[i]["held_out"]]
    assert len(held) > 40 and all(by[i]["predicted"] == truth[i] for i in held)
    for k, t in enumerate(tricks):
        assert by[1000 + k]["predicted"] == 1, t
    assert not any(by[i]["predicted"] for i, _ in fine)
    assert by[3000]["score"] == by[3001]["score"] < 0.5 and by[None]["predicted"] == 1 and by[3002]["predicted"] == 1


def test_labels_of_held_out_rows_are_not_learned(spark):
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0]
    rows = [(k, "secret word" if k in held else "plain word") for k in range(400)]
    got = X.toxic_scores(*frames(spark, rows, [(k, int(k in held)) for k in range(400)])).collect()
    assert not any(r["predicted"] for r in got)


def test_empty_tables(spark):
    docs, labels = frames(spark, [(1, "a b")], [(1, 1)])
    assert X.toxic_scores(docs.limit(0), labels.limit(0)).count() == 0
    (row,) = X.toxic_scores(docs, labels.limit(0)).collect()
    assert row["score"] == 0.0 and row["predicted"] == 0


def test_trigram_counts():
    c = X.trigram_counts("Ab,  é!").reshape(28, 28, 28)
    assert c[0, 0, 1] + c[0, 1, 2] + c[1, 2, 0] + c[2, 0, 5] + c[0, 5, 0] == c.sum() == 5
    assert np.allclose(np.exp(X.language_model({1: 5})).sum(2), 1)


def test_decoder_takes_the_likelier_letter():
    lm = X.language_model({int(k): int(n) for k, n in enumerate(sum(X.trigram_counts(t) for t in ["idiot said", "the little island", "list"] * 20)) if n})
    m = X.Model(lm)
    assert m.decode("1d1ot") == ("idiot",) and m.decode("l1tt1e") in (("little",), ("littie",)) and m.decode("i d i o t", True) == ("idiot",)


@pytest.mark.parametrize("copies", [1, 40])
def test_near_copies_count_once(copies):
    rng = random.Random(3)
    fresh = lambda: [f"w{rng.randrange(10**6)}" for _ in range(30)]
    one = fresh() + ["scum"]
    texts = [([*one, f"extra{k}"], 1) for k in range(copies)] + [(fresh() + ["scum"], 1) for _ in range(30)] + [(fresh(), 0) for _ in range(200)]
    m = X.fit_lexicon(X.language_model({}), [(set(t), y, X.sketch(" ".join(t))) for t, y in texts], 0.1, X.Params())
    assert set(m.weights) == {"scum$"}


def test_long_runs_letterless_tokens_and_short_spaced_words(spark, monkeypatch):
    monkeypatch.setitem(globals(), "BAD", [*BAD, "bozo", "ass"])
    rows, labels = corpus(random.Random(12), 600)
    joined = lambda sign, *more: sign.join(FINE[:12] + list(more) + FINE[12:])
    tricks = [joined("_", "m0r0n"), joined(",", "$cum"), joined("/", "l0ser"), joined("-", "s*c*u*m"), "l" + "o" * 70 + "ser", "x" * 300 + " " + "_".join(["house"] * 60 + ["m0r0n"]),
              "8020", "455", "(8020)", "a s s", "a.s.s", "4 5 5"]
    odd = [(1000 + k, f"the people walk {t} under a bridge") for k, t in enumerate(tricks)]
    fine = [joined("_"), joined(","), joined("/"), joined("-"), "l" + "o" * 70 + "w", "2024 100 17 --- *** !!! |", "a b c 1 2 3 x.y", "0" * 5000, ""]
    fine = [(2000 + k, f"the people walk {t} under a bridge") for k, t in enumerate(fine)]
    by = {r["doc_id"]: r["predicted"] for r in X.toxic_scores(*frames(spark, rows + odd + fine, labels)).collect()}
    assert [t for k, t in enumerate(tricks) if not by[1000 + k]] == []
    assert [t for i, t in fine if by[i]] == []


def test_decoding_of_a_long_run_is_that_of_its_parts():
    n = sum(X.trigram_counts(t) for t in ["idiot said", "the little island", "list"] * 20)
    m = X.Model(X.language_model({int(k): int(v) for k, v in enumerate(n) if v}))
    assert m.decode(" ".join(["1d1ot"] * 3000)) == ("idiot",) * 3000 and m.decode("abc" * 20000) == ("abc" * 20000,)


def model(texts, weights=None):
    n = sum(X.trigram_counts(t) for t in texts)
    return X.Model(X.language_model({int(k): int(v) for k, v in enumerate(n) if v}), weights or {})


PROSE = ["the idiot said hello to a little moron", "see the book in the street", "an island of coffee and apples", "he took a letter off the wall", "all people went home after summer"] * 30


def test_disguises_are_restored_by_the_lattice():
    m = model(PROSE)
    for t in ("idiiot", "iidiott", "idiiiot", "i d-i.o t", "i  d  i  o  t", "i\nd\ni\no\nt", "i . d _ i * o - t", "idіot", "idiоt", "іdіоt", "1dі0t", "IDII0T", "i-d-i  o\tt"):
        assert "idiot" in m.restored(t), t
    for t in ("little", "hello", "street", "coffee", "letter", "summer"):
        assert m.words(t) == (t,), t
    assert m.words("дом") == ("дом",) or "дом" in m.words("дом")


def test_words_in_parts():
    m = model(PROSE, {"idiot$": 5.0, "moro": 4.0})
    for t in ("id iot", "idi ot", "i d i0t", "1d iot", "id\n\niot", "the id i o t here", "mor on", "m0rо n"):
        tokens = t.split()
        assert any(m.hits(w) for w in m.joined(tokens, {c for c in tokens if m.told(c)[1]})) or any(m.hits(w) for w in m.restored(t)), t
    for t in ("the idea of it", "more on tuesday", "i do it", "mor the on", ""):
        tokens = t.split()
        assert not any(m.hits(w) for w in m.joined(tokens, {c for c in tokens if m.told(c)[1]})), t


@pytest.mark.parametrize("spaced", [False, True])
def test_viterbi_finds_the_best_of_all_paths(spaced):
    m = model(PROSE)
    rng = random.Random(6)

    def paths(token, i=0):
        """All readings of a token: (text, log-probability of the channel)."""
        if i == len(token):
            yield "", 0.0
            return
        j = i
        while j < len(token) and token[j] == token[i]:
            j += 1
        for said, cost in m.readings(token[i], j - i, spaced):
            for rest, more in paths(token, j):
                yield said + rest, cost + more

    def likelihood(text):
        p = q = 0
        total = 0.0
        for c in [*text, " "]:
            x = 0 if c == " " else int(X.fold(c)[0])
            if x or q:
                total += m.lm[p, q, x]
                p, q = q, x
        return total

    for _ in range(150):
        token = "".join(rng.choice("idot1l0o- .eéоs$") for _ in range(rng.randrange(1, 9)))
        scored = [(cost + likelihood(said), said) for said, cost in paths(token)]
        best = max(s for s, _ in scored)
        got = m.decode(token, spaced)
        assert got in {tuple(said.split()) for s, said in scored if s > best - 1e-9}, token


def test_words_that_no_reading_concerns_are_not_decoded():
    """The short way for doubled letters gives the hits of the whole lattice."""
    m = model(PROSE, {"idiot$": 5.0, "moro": 4.0, "loo": 3.0, "ass$": 2.0})
    full = model(PROSE)
    rng = random.Random(2)
    for _ in range(3000):
        word = "".join(rng.choice("idotmrnlas") * rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randrange(1, 7)))
        assert {h for w in m.words(word) for h in m.hits(w)} == set(m.told(word)[0]) == {h for w in full.words(word) for h in m.hits(w)}, word
        assert set(m.told(word)[1]) == {w for w in full.words(word) if w in m.stems}, word
