import math
import random
from collections import Counter

import sentencepiece

from mesura.llm import quality as Q
from mesura.llm.common import tokenizer_file

WHITE = " \t\n\x0b\x0c\r"


def split(text):
    out, now = [], ""
    for c in text:
        if c in WHITE:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out + [now] * bool(now)


def base(text):
    w, seen, dup = split(text or ""), set(), 0
    for line in (text or "").split("\n"):
        if split(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    n = Counter(windows)
    marked = {j for k, x in enumerate(windows) if n[x] > 1 for j in range(k, k + 3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(marked)


def rows(rng):
    vocab = ["the", "water", "people", "house", "garden", "morning", "river", "letter", "yellow", "music", "window", "table", "number", "story", "mother", "little", "always", "under", "through", "between"]
    fine = [(k, " ".join(rng.choice(vocab) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(60, 200))), ["en", "fr"][k % 2] if k % 7 else None) for k in range(240)]
    odd = [(300, None, "en"), (301, "", "en"), (302, "a b c " * 60, "en"), (303, "line\nline\n \n\n \nline " * 9, "en"), (304, "日本語 " * 60, None),
           (305, " ".join("".join(rng.choice("0123456789abcdef#$%&*") for _ in range(30)) for _ in range(80)), "en"), (306, "x\u00a0y z\x1cw " * 3, "en"), (None, fine[0][1], "en"), (0, fine[1][1], "en"),
           (307, "one two three four five six seven", None), (308, " ".join(f"w{k}" for k in range(30000)), "en")]
    return fine + odd


def test_against_brute_force(spark):
    data = rows(random.Random(2))
    p = Q.Params()
    df = spark.createDataFrame([(*r, 1, "g") for r in data], "doc_id long, text string, lang string, n_words int, grp string")
    got = Q.judged(df, p).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(p.vocabulary))
    want, measured = [], []
    for i, text, lang in data:
        b = base(text)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        ids = sp.encode(text or "")
        n = len(ids)
        c = Counter(ids)
        m = (float(len(text or "")), 0.0, 1.0) if n < 2 else (
            len(text) / n, sum(v for k, v in c.items() if sp.is_byte(k) or sp.is_unknown(k)) / n, -sum(v / n * math.log2(v / n) for v in c.values()) / math.log2(min(n, p.entropy_tokens)))
        measured.append((lang or Q.script(text or ""), failed, m))
        want.append([i, *b, failed])
    groups = Counter(g for g, f, _ in measured if not f)

    def band(g, k):
        use = [m[k] for x, f, m in measured if not f and (x == g or groups[g] < p.least)]
        cells = sorted(math.floor(v * p.bins) for v in use)
        at = lambda q: cells[math.ceil(q * len(cells)) - 1] / p.bins
        a, b = at(0.25), at(0.75)
        return a - p.fence * (b - a) - p.slack[k], b + 1 / p.bins + p.fence * (b - a) + p.slack[k]

    for w, (g, failed, m) in zip(want, measured):
        low, _ = band(g, 0)
        _, high = band(g, 0)
        w.append(not failed and low <= m[0] <= high and m[1] <= band(g, 1)[1] and m[2] >= band(g, 2)[0])
    key = lambda r: (str(r[0]), *r[1:])
    assert sorted((tuple(r)[:8] for r in got), key=key) == sorted(map(tuple, want), key=key)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not kept[305] and not kept[302] and not kept[300]
    assert sum(kept[k] for k in range(1, 240)) >= 238


def test_empty_and_failing_tables(spark):
    schema = "doc_id long, text string, lang string"
    assert Q.judged(spark.createDataFrame([], schema)).count() == 0
    got = Q.judged(spark.createDataFrame([(1, None, None), (2, "a", "en")], schema)).collect()
    assert [r["kept"] for r in got] == [False, False]


def test_scripts():
    assert [Q.script(t) for t in ("abc é", "Привет", "日本", "한국", "123", "")] == ["Latin", "Cyrillic", "Han", "Hangul", "other", "other"]


def test_small_groups_are_judged_by_their_own_bands(spark):
    rng = random.Random(4)
    text = lambda words: " ".join(rng.choice(words) for _ in range(rng.randrange(80, 160)))
    english = "the water people house garden morning river letter yellow music window table number story mother little".split()
    thai = "น้ำ คน บ้าน สวน เช้า แม่น้ำ จดหมาย สีเหลือง ดนตรี หน้าต่าง โต๊ะ ตัวเลข เรื่อง แม่ เล็ก เสมอ".split()
    foreign = " ".join(rng.choice(english) for _ in range(80))
    data = [(k, text(english), "en") for k in range(2000)]
    for n, lang in ((1, "t1"), (5, "t5"), (40, "t40"), (99, "t99"), (100, "t100")):
        data += [(10000 * n + k, text(thai), lang) for k in range(n)]
    data += [(5000, foreign, "t40"), (5001, foreign, "t99")]
    got = {(r["doc_id"], r["n_words"]): r["kept"] for r in Q.judged(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    lost = [i for (i, _), kept in got.items() if i >= 10000 and not kept]
    assert lost == [] and not got[5000, 80] and not got[5001, 80]
