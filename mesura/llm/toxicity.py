"""Toxicity by noisy-channel deobfuscation and a learned lexicon.

A disguised word ("1d10t", "i d i o t", "id*iot", "idiiot") is a path through
a character lattice: a figure or sign stands for a letter, a letter of another
alphabet for the one it looks like, a separator for nothing or for a word's
end, a run of a letter for one or two of it, a blank for a word's end or, at a
cost, for nothing. Viterbi decoding under a character trigram model of the
corpus picks the path; the restored text is scored. Runs of any length are
decoded, and so are tokens without a letter ("455") and words of two spaced
signs or more, whatever separators and line ends stand between them; what that
makes of plain numbers counts against a lexicon entry where clean texts have it
too. Words in parts ("id iot") are decoded where a part begins a lexicon word
and the parts behind complete it: nothing else could change the score.

The trigram model counts all documents (28 symbols cubed, summed before any
shuffle). The lexicon is fitted on a bounded sample of labelled rows: words
and word beginnings that occur, counting near copies once, in toxic texts far
more often than chance, closed under equal coverage. A text's score is the
logistic sum of the weights of its lexicon hits.
"""

from __future__ import annotations

import math
import os
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesura.llm.common import doc_split, read_table, register

# What a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "¡": "i"}
#: Letters of other alphabets and the Latin letters that they look like.
LOOKALIKES = dict(zip("аеорсухіѕјһԁԛԝмтвнк" "οανιρτυκεχηω" "ıøłđðħŧɑɡɩʟ", "aeopcyxisjhdqwmtbhk" "oavlptukexnw" "iolddhtagil"))
SEPARATORS = " \t\n\r\v\f.,-_*~/\\'`^#%&:;="
EDGE = "\"'()[]{}<>.,;:!?*#%&$|=~_-…«»“”‘’„¿¡"
SYMBOLS = 28  # word end, a to z, any other letter
KEPT = 64  # longer runs are seldom met again: decoded each time, not remembered

_COST = {"sign": -1.0, "alike": -1.0, "drop": -0.7, "end": -2.5, "run": -0.5, "double": -4.0, "join": -2.5}
_SPACED = re.compile(r"(?<!\S)[^\s._*\-](?:[\s._*\-]++[^\s._*\-](?=[\s._*\-,;:!?]|$))++")
_ALIKE = re.compile("[" + "".join(LOOKALIKES) + "]")
_DOUBLE = re.compile(r"(.)\1+")
_PLAIN = re.compile(r"(?:([^\W\d_])(?!\1))+")


@dataclass(frozen=True)
class Params:
    """``toxic_rows`` and ``clean_rows`` bound the labelled sample (in order
    of a hash of the id). ``evidence`` is the log-likelihood ratio at which a
    feature enters the lexicon, ``weak`` that for toxic texts nothing else
    explains; beginnings have ``prefix`` letters at least."""

    toxic_rows: int = 1500
    clean_rows: int = 6000
    evidence: float = 16.0
    weak: float = 6.0
    prefix: int = 4
    threshold: float = 0.5


def _fold_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x30000):
        ch = chr(c)
        if ch.isalpha():
            base = unicodedata.normalize("NFD", ch)[0].lower()
            table[c] = ord(base) - 96 if "a" <= base <= "z" else 27
    return table


_TABLE: list[np.ndarray] = []


def fold(text: str) -> np.ndarray:
    """Symbols of a text: 0 for what is no letter, 1 to 26 for a to z without
    marks, 27 for other letters."""
    if not _TABLE:
        _TABLE.append(_fold_table())
    return _TABLE[0][np.frombuffer(text.encode("utf-32-le"), np.uint32)]


def trigram_counts(text: str) -> np.ndarray:
    s = np.concatenate([[0, 0], fold(text), [0]]).astype(np.int32)
    s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]  # one word end between words
    s = np.concatenate([[0], s])
    return np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS ** 3)


_NOTHING: tuple[tuple[str, ...], tuple[str, ...]] = ((), ())


@dataclass
class Model:
    """``lm``: log-probability of a symbol after two. ``weights``: lexicon of
    beginnings ("lose") and whole words ("loser$"). The log-odds of a text are
    ``base`` for one without hits, plus ``most`` times the largest weight of
    its hits and ``more`` times the sum of the others."""

    lm: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    base: float = -math.inf
    most: float = 0.0
    more: float = 0.0
    longest: int = 0

    def __post_init__(self):
        self.kept: dict[str, tuple[str, ...]] = {}
        self.sums: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {}
        self.longest = max((len(k.rstrip("$")) for k in self.weights), default=0)
        #: What a part of a lexicon word may begin with.
        self.stems: dict[str, set[str]] = {}  # with the letters that an entry goes on with
        for k in (x.rstrip("$") for x in self.weights):
            for n in range(1, len(k)):
                self.stems.setdefault(k[:n], set()).add(k[n])
        once = {_DOUBLE.sub(r"\1", k.rstrip("$")) for k in self.weights}
        self.single = once | {k[:n] for k in once for n in range(1, len(k))}, once
        self.heads = {k[:3] for k in once}

    def __getstate__(self):
        return {**self.__dict__, "kept": {}, "sums": {}}

    @staticmethod
    def readings(c: str, n: int, spaced: bool) -> list[tuple[str, float]]:
        """What ``n`` of the sign ``c`` in a row may stand for, and the channel's
        log-probability of each."""
        if c.isalpha():
            k = 2 if n == 2 else 1
            found = [(c, 0.0)] if n == 1 else [(c, _COST["double" if n == 2 else "run"]), (c * 2, 0.0 if n == 2 else _COST["run"])]
            return found + [(x * m, cost + k * _COST["alike"]) for x in LOOKALIKES.get(c, "") for m, cost in ((len(f), w) for f, w in found)]
        found = [(x * m, m * _COST["sign"]) for x in LEET.get(c, "") for m in {1, min(n, 2)}]
        if spaced and (c in SEPARATORS or not found):
            return [*found, ("", 0.0), (" ", 4 * _COST["end"])]
        if c.isspace():
            return [(" ", 0.0), ("", _COST["join"])]
        return [*found, ("", _COST["drop"]), (" ", _COST["end"])] if c in SEPARATORS or not found else found

    def decode(self, token: str, spaced: bool = False) -> tuple[str, ...]:
        """Words of the most likely path through the token's lattice. In a
        ``spaced`` token a separator stands between any two signs. Time is
        linear in the token: what all paths share is put aside."""
        # edges by position: (end, emitted text, log-probability of the channel)
        states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        shared: list[str] = []
        i, check = 0, 256
        while i < len(token):
            if i >= check:
                head = os.path.commonprefix([said for _, said in states.values()])
                shared.append(head)
                states = {k: (s, said[len(head):]) for k, (s, said) in states.items()}
                check = i + 256 + max(len(said) for _, said in states.values())
            if len(states) == 1 and (m := _PLAIN.match(token, i)) and m.end() - i > 2 and m[0].isalpha() and not _ALIKE.search(m[0]):
                # one path in, one letter a sign: one path out, whatever its score
                a, b = _symbol(m[0][-2]), _symbol(m[0][-1])
                if a and b:
                    ((score, said),) = states.values()
                    shared += [said, m[0]]
                    states, i = {(a, b): (score, "")}, m.end()
                    continue
            c = token[i]
            j = i + 1
            while j < len(token) and token[j] == c:
                j += 1
            options = self.readings(c, j - i, spaced)
            reached: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, said) in states.items():
                for out, cost in options:
                    p, q, s = a, b, score + cost
                    for ch in out:
                        x = 0 if ch == " " else _symbol(ch)
                        if x or q:
                            s += self.lm[p, q, x]
                            p, q = q, x
                    if (p, q) not in reached or s > reached[p, q][0]:
                        reached[p, q] = (s, said + out)
            states = reached
            i = j
        _, said = max(((s + (self.lm[a, b, 0] if b else 0.0), said) for (a, b), (s, said) in states.items()), key=lambda x: (x[0], x[1]))
        return tuple("".join([*shared, said]).split())

    def concerns(self, word: str) -> bool:
        """Whether a reading of a word of Latin letters, doubled ones as one or
        two, can begin with or be part of a lexicon entry: all its readings are
        alike with every doubled letter taken once."""
        once = _DOUBLE.sub(r"\1", word)
        parts, whole = self.single
        return once in parts or any(once[:k] in whole for k in range(1, min(len(once), self.longest) + 1))

    def words(self, chunk: str) -> tuple[str, ...]:
        """Restored words of a run of non-blank characters, lower-case."""
        found = self.kept.get(chunk)
        if found is None:
            core = chunk.strip(EDGE)
            if _PLAIN.fullmatch(core) and not _ALIKE.search(core):
                # a sign right before or behind the letters may be one of them
                at = chunk.find(core)
                before, behind = chunk[max(0, at - 1):at], chunk[at + len(core):]
                near = (before if before in LEET else "") + core + ("$" if behind == "$" else "")
                found = (core, *(() if near == core else self.decode(near)))
            elif self.weights and chunk.isalpha() and not _ALIKE.search(chunk) and not self.concerns(chunk):
                found = (chunk,)
            else:
                bare = chunk.rstrip(".,;:?\"'").lstrip("\"'(")
                forms = {t: None for t in (core, bare) if any(c.isalpha() or c in LEET for c in t)}
                found = dict.fromkeys(w for t in forms for w in self.decode(t))
                found = tuple(found | dict.fromkeys(re.findall(r"[^\W\d_]+", core)))
            if len(chunk) <= KEPT:
                if len(self.kept) > 100_000:
                    self.kept.clear()
                self.kept[chunk] = found
        return found

    def restored(self, text: str) -> set[str]:
        """Distinct words of the restored text."""
        text = text.lower()
        out = {w for c in set(text.split()) for w in self.words(c)}
        for m in _SPACED.finditer(text):
            out.update(self.unspaced(m[0]))
        return out

    def unspaced(self, span: str) -> set[str]:
        """Words of a run of single signs."""
        return set(self.decode(span, True))

    def apart(self, token: str) -> bool:
        """Whether a token of Latin letters begins with three, doubled letters
        taken once, that no lexicon entry begins with: no reading of it can hit
        or begin an entry."""
        if not token.isalpha() or _ALIKE.search(token):
            return False
        once = _DOUBLE.sub(r"\1", token)
        return len(once) > 2 and not any(once[:k] in self.heads for k in (1, 2, 3))

    def told(self, token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Lexicon entries that a token's readings have, and its readings that
        begin an entry."""
        got = self.sums.get(token)
        if got is None:
            words = () if self.apart(token) else self.words(token)
            got = (tuple(dict.fromkeys(h for w in words for h in self.hits(w))), tuple(w for w in words if w in self.stems))
            if len(token) <= KEPT:
                if len(self.sums) > 150_000:
                    self.sums.clear()
                self.sums[token] = got if got[0] or got[1] else _NOTHING
        return got

    def joined(self, tokens: list[str], begins: set[str]) -> set[str]:
        """Words that the lattice reads across blanks, of tokens that spell a
        lexicon entry together: one of ``begins`` and those behind that go on
        with it, so a span has no more tokens than the longest entry letters."""
        out: set[str] = set()
        for i in [i for i, c in enumerate(tokens) if c in begins] if begins else []:
            so_far, j = set(self.told(tokens[i])[1]), i + 1
            while so_far and j < len(tokens):
                longer = {(a, a + w) for w in self.words(tokens[j]) for a in so_far if w[0] in self.stems[a]}
                if any(len(h.rstrip("$")) > len(a) for a, w in longer for h in self.hits(w)):
                    out.update(self.decode(" ".join(tokens[i:j + 1])))
                so_far, j = {w for _, w in longer if w in self.stems}, j + 1
        return out

    def hits(self, word: str) -> list[str]:
        found = [word + "$"] if word + "$" in self.weights else []
        return found + [word[:k] for k in range(1, min(len(word), self.longest) + 1) if word[:k] in self.weights]

    def measures(self, found: set[str]) -> tuple[float, float]:
        """Largest weight and bounded sum of the other weights."""
        w = sorted((self.weights[h] for h in found), reverse=True)
        return (w[0], min(30.0, sum(w[1:]))) if w else (0.0, 0.0)

    def score(self, text: str | None) -> float:
        """0 to 1; a null or empty text has the score of a text without hits."""
        text = (text or "").lower()
        found: set[str] = set()
        tokens = text.split()
        begins: set[str] = set()
        for c in set(tokens):
            entries, starts = self.told(c)
            if entries:
                found.update(entries)
            if starts:
                begins.add(c)
        for m in _SPACED.finditer(text):
            found.update(h for w in self.unspaced(m[0]) for h in self.hits(w))
        found.update(h for w in self.joined(tokens, begins) for h in self.hits(w))
        most, more = self.measures(found)
        z = self.base + self.most * most + self.more * more if found else self.base
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


_SYMBOL: dict[str, int] = {}


def _symbol(ch: str) -> int:
    s = _SYMBOL.get(ch)
    if s is None:
        s = _SYMBOL[ch] = int(fold(ch)[0])
    return s


def language_model(counts: dict[int, int]) -> np.ndarray:
    """log P(c | a, b), trigram counts interpolated with bigrams and letters."""
    n = np.zeros(SYMBOLS ** 3)
    for k, v in counts.items():
        n[k] = v
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    one = (n.sum((0, 1)) + 1) / (n.sum() + SYMBOLS)
    two = (n.sum(0) + 5 * one) / (n.sum((0, 2))[:, None] + 5)
    three = (n + 5 * two[None]) / (n.sum(2)[:, :, None] + 5)
    return np.log(three)


def count_trigrams(docs: DataFrame, text_col: str = "text") -> dict[int, int]:
    """Trigram counts of all texts: one row of partial sums for each task's
    trigram, at most 28 cubed in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += trigram_counts(t.as_py() or "")
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(total[k])], names=["k", "n"])
    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "k long, n long")
    return {r[0]: r[1] for r in rows.groupBy("k").agg(F.sum("n").alias("n")).collect()}


def _features(words: Collection[str], prefix: int) -> set[str]:
    return {w + "$" for w in words if len(w) >= 2} | {w[:k] for w in words for k in range(prefix, min(len(w), 12) + 1)}


def sketch(text: str, size: int = 8) -> tuple[int, ...]:
    """The least hashes of a text's three-word shingles; near copies share
    many of them."""
    w = text.lower().split()
    return tuple(sorted({xxhash.xxh3_64_intdigest(" ".join(w[k:k + 3])) for k in range(max(1, len(w) - 2))})[:size])


def _copies(sketches: list[tuple[int, ...]]) -> list[int]:
    """Group of each text; those that share three eighths of their sketch with
    a group's member are its near copies."""
    group, at = list(range(len(sketches))), defaultdict(set)
    for i, least in enumerate(sketches):
        shared = Counter(g for m in least for g in at[m])
        best = max(shared.items(), key=lambda x: (x[1], -x[0]), default=(i, 0))
        if 8 * best[1] >= 3 * len(least) > 0:
            group[i] = best[0]
        for m in least:
            at[m].add(group[i])
    return group


def fit_lexicon(lm: np.ndarray, rows: list[tuple[Collection[str], int, tuple[int, ...]]], share: float, p: Params) -> Model:
    """Lexicon from distinct restored words with labels and sketches; ``share`` is
    the share of toxic rows among all labelled ones, for the base odds."""
    toxic, clean = [w for w, y, _ in rows if y], [w for w, y, _ in rows if not y]
    if not toxic or not clean:
        known = math.inf if toxic else -math.inf  # one class, or none
        return Model(lm, {}, known)
    groups: dict[int, set[str]] = defaultdict(set)
    for g, words in zip(_copies([x for _, y, x in rows if y]), toxic):
        groups[g].update(words)
    copies, n1 = len(groups), Counter()
    for words in groups.values():  # features are made on the way, not kept
        n1.update(_features(words, p.prefix))
    n1 = Counter({f: n for f, n in n1.items() if n >= 2})
    n0 = Counter(f for words in clean for f in _features(words, p.prefix) if f in n1)
    prior = copies / (copies + len(clean))

    def ratio(f: str) -> float:
        a, b = n1[f], n0[f]
        if a / (a + b) <= prior:
            return 0.0
        return a * math.log(a / (a + b) / prior) + (b * math.log(b / (a + b) / (1 - prior)) if b else 0.0)

    scored = {f: r for f in n1 if n0[f] * 10 <= n1[f] and (r := ratio(f)) >= p.weak}
    # closed: no longer form covers as much
    longer = {(f[:-1], n1[f], n0[f]) for f in scored}
    closed = {f: r for f, r in scored.items() if (f, n1[f], n0[f]) not in longer or f.endswith("$")}
    # of a beginning and its longer forms the beginning; a longer form too, where it is purer
    chosen: dict[str, None] = {}
    for f in sorted(closed, key=lambda f: (len(f), f)):
        stem = f.rstrip("$")
        parts = [stem[:k] for k in range(p.prefix, len(stem) + 1) if stem[:k] in chosen]
        if closed[f] >= p.evidence and not any(n0[x] * n1[f] <= n0[f] * n1[x] for x in parts):
            chosen[f] = None
    covers = lambda words: any(f in chosen for f in _features(words, p.prefix))
    left = [words for words in groups.values() if not covers(words)]
    while left:
        gain = Counter(f for words in left for f in _features(words, p.prefix) if f in closed and f not in chosen)
        best = max(gain, key=lambda f: (gain[f], closed[f], f), default=None)
        if best is None or gain[best] < 2:
            break
        chosen[best] = None
        left = [words for words in left if best not in _features(words, p.prefix)]
    weights = {f: math.log((n1[f] + 0.5) / (copies + 1)) - math.log((n0[f] + 0.5) / (len(clean) + 1)) for f in chosen}
    model = Model(lm, weights)
    x = np.array([(1.0, *model.measures({h for w in words for h in model.hits(w)})) for words, _, _ in rows])
    y = np.array([label for _, label, _ in rows], float)
    model.base, model.most, model.more = logistic(x, y, np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean())))
    return model


def logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Coefficients, all but the first at least 0, by Newton's method with a
    small ridge; ``rows`` are the weights of the rows."""
    used = np.ones(x.shape[1], bool)
    while True:
        c, z = np.zeros(x.shape[1]), x[:, used]
        penalty = ridge * np.array([0.01] + [1.0] * (int(used.sum()) - 1))
        b = np.zeros(z.shape[1])
        for _ in range(60):
            prob = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            grad = z.T @ (rows * (y - prob)) - penalty * b
            step = np.linalg.solve((z * (rows * prob * (1 - prob))[:, None]).T @ z + np.diag(penalty), grad)
            b += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        c[used] = b
        low = (c < 0) & (np.arange(len(c)) > 0)
        if not low.any():
            return tuple(float(v) for v in c)
        used &= ~low


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of ``docs`` and the labels 0/1 of ``labels``. Null labels and
    ids are left out; an id with several labels has the larger."""
    lm = language_model(count_trigrams(docs, text_col))
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    totals = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    order = [F.xxhash64("id"), F.col("id")]
    sample = (known.filter("y = 1").orderBy(*order).limit(p.toxic_rows)
              .union(known.filter("y = 0").orderBy(*order).limit(p.clean_rows)))
    seed = Model(lm)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            said = ["\n".join(sorted(seed.restored(t))) for t in texts]
            least = [" ".join(map(str, sketch(t))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), pa.array(least, pa.string())], names=["y", "words", "sketch"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null")
    most = p.toxic_rows + p.clean_rows
    # the broadcast side holds at most toxic_rows + clean_rows ids
    said = (texts.join(F.broadcast(sample), "id").select("y", "text").mapInArrow(words, "y int, words string, sketch string").distinct()
            .orderBy(F.xxhash64("words", "y"), "words", "y", "sketch").limit(most).collect())
    one: dict[str, str] = {}  # texts share the words they have in common
    rows = [(tuple(one.setdefault(w, w) for w in r["words"].split("\n") if w), r["y"], tuple(map(int, r["sketch"].split()))) for r in said]
    count = sum(totals.values())
    return fit_lexicon(lm, rows, totals.get(1, 0) / count if count else 0.0, p)


def scored(docs: DataFrame, model: Model, text_col: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the score of each text in column ``to``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # lexicon and 28 cubed numbers

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        return texts.map(m.score, na_action=None)

    return docs.withColumn(to, score(F.col(text_col).cast("string")))


def toxic_scores(docs: DataFrame, labels: DataFrame, p: Params = Params()) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one for each row of ``docs``.

    Labels of held-out rows (crc32 of the id as text divisible by 5) are not
    learned from. A null id is not held out. Rows that repeat an id are scored
    each for its text, equal texts alike; an id with several labels has the
    larger. A score of exactly the threshold is toxic. Very long texts are read
    whole. Without any label the score is 0. Other columns of either table are not read. An empty table gives an empty
    result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = fit(rows, labels.filter(doc_split("doc_id", 5) != 0), p)
    return scored(rows, model).select(
        "doc_id", F.coalesce(doc_split("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= p.threshold).cast("int").alias("predicted"))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
