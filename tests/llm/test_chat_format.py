import hashlib
import random

import numpy as np

from mesura.llm import chat_format as C
from mesura.llm.common import tokenizer_file

SCHEMA = "conv_id long, turn long, role string, text string, part int, last string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r is not None, r or "", x is not None, x or ""))
    out = []
    for c, turns in convs.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        chars = sum(len(C.escape(r)) + len(C.escape(x)) + 32 for r, x in turns)
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss), chars))
    return sorted(out, key=str)


ROWS = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello <|im_end|> <\\|x <|endoftext|>"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", " \n leading <"),
        (2, 0, None, "no role"), (2, None, "assistant", "no turn"), (3, 1, "assistant", "b"), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (None, 0, "assistant", "no id"),
        (4, 0, "a<|im_sep|>b", "日本 😀 ñé \x00"), (4, 1, "assistant", "日本 😀 ñé|<|<\\\\|"), (5, 0, "system", "only"), (6, 0, "assistant", "x" * 30000)]
ROWS += [(7, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 9)) for k in range(300)]
ROWS += C.HOSTILE


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA)


def test_read_back_equals_brute_force(spark):
    for p in (C.Params(), C.Params(chunk=50)):
        got = C.digests(C.format_conversations(frame(spark, ROWS), p), p)
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS)


def test_empty_table(spark):
    got = C.format_conversations(frame(spark, []))
    assert got.count() == 0 and C.digests(got).count() == 0


def test_escape_is_reversible_and_hides_control_strings():
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("<|\\a") for _ in range(rng.randrange(9)))
        assert C.unescape(C.escape(t)) == t and "<|" not in C.escape(t)


def test_masks_are_aligned():
    t = C.tokenizer(tokenizer_file("byte_bpe_50k.json"))
    turns = [("user", "a b"), ("assistant", "\n\n 日 x\n"), ("assistant", ""), ("user", "assistant"), ("assistant", "!")]
    text, spans = C.render(turns, "assistant")
    code = t.encode(text, add_special_tokens=False)
    ranges = C.masked_tokens(np.array(code.offsets), spans)
    assert [t.decode(code.ids[a:b], skip_special_tokens=False) for a, b in ranges] == [x for r, x in turns if r == "assistant"]
    covered = {k for a, b in ranges for k in range(a, b)}
    inside = {k for k, (x, y) in enumerate(code.offsets) if any(s <= x and y <= e and x < y for s, e in spans)}
    assert covered == inside
