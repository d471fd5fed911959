import numpy as np
import pytest

from mesura.llm import html_extract as H


def page(title, paras, extra=""):
    return (f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>menu one</a></li><li><a href=/b>two</a></li></ul></nav>"
            f"<!-- c --><div class=\"ad\">Buy now the thing.</div><article><h1>{title}</h1>" + "".join(f"<p>{p}</p>" for p in paras) + f"</article>{extra}<footer>&copy; host &middot; words</footer></body></html>")


def words(k, n):
    return " ".join(f"word{(k * 7 + j) % 50}" for j in range(n)) + "."


def test_blocks():
    got = H.blocks('a&amp;b <b>c</b>\n\t d<p>x<p>y<br>z &lt;tag&gt; &copy<script>if (1<2) "</p>"</script><div class="x y">in<!-- <p>no</p> -->side</div tail')
    assert [b.text for b in got] == ["a&b c d", "x", "y z <tag> ©", "inside"]
    assert ".x" in got[3].path and "div" in got[3].path and got[0].path == ()
    assert H.blocks("") == [] and H.blocks("   ") == [] and [b.text for b in H.blocks("<p")] == []
    assert [b.text for b in H.blocks("<li>a<li>b<ul><li>c</ul></li>d")] == ["a", "b", "c", "d"]
    assert [b.linked for b in H.blocks("<p><a href=x>all</a></p><p>none</p>")] == [1.0, 0.0]
    assert [b.text for b in H.blocks("x < y &am &nope; é&#233;&#x41; > <p title='a>b'>t")] == ["x < y &am &nope; ééA >", "t"]
    deep = H.blocks("<div>" * 3000 + "deep" + "</div>" * 3000)
    assert deep[0].text == "deep" and len(deep[0].path) == 64
    assert sum(len(b.text) for b in H.blocks("<p>" + "long " * 200000)) == 999999


def test_gradients_are_right():
    p = H.Params(paths=8, words=8, width=2, hidden=3)
    net, f = H.Labeller(p), H.Features(p)
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    pages = [H.blocks("<p>a b<p>c<div class=x>d e</div>"), H.blocks("<p>q")]
    group = [(f.of(b), np.arange(len(b)) % 2.0) for b in pages]

    def loss():
        total, n = 0.0, 0
        for (fe, y), prob in zip(group, net.probabilities(pages, f)):
            total -= (y * np.log(prob) + (1 - y) * np.log(1 - prob)).sum()
            n += len(y)
        return total / n

    grads = net.gradients(group)
    for k in net.w:
        flat = net.w[k].ravel()
        for i in np.linspace(0, flat.size - 1, 6).astype(int):
            old, step = flat[i], 1e-2
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - grads[k].ravel()[i]) < 2e-3, k


@pytest.fixture(scope="module")
def site():
    return [(k, f"http://x/{k}", page(words(k, 6), [words(k + j, 12 + j) for j in range(1 + k % 6)])) for k in range(60)]


def truth(html):
    return " ".join(b.text for b in H.blocks(html.split("<article>")[1].split("</article>")[0]))


def test_extraction(spark, site):
    side = '<aside class="sidebar"><h3>Related</h3><ul><li><a href=/x>other</a></li></ul></aside><section class="comments"><div class="comment"><p>word1 word2 great.</p></div></section>'
    more = [(100, None, None), (101, "u", ""), (None, "u", site[0][2]), (3, "again", site[3][2]), (102, "u", "<nav><a href=/>home</a></nav><footer>foot</footer>"),
            (103, "u", page(words(1, 5), [words(2, 30), words(3, 30)], side)), (104, "u", page("big", [words(k, 20) for k in range(3000)]))]
    df = spark.createDataFrame([(*r, "t", 5) for r in site + more], "page_id long, url string, html string, text string, n_chars int")
    got = H.main_text(df, H.Params(epochs=6)).collect()
    assert len(got) == len(site + more)
    want = {(i, u): truth(h) if h and "<article>" in h else "" for i, u, h in site + more}
    assert {(r["page_id"], r["url"]): r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_empty_table(spark):
    assert H.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_new_skeletons(site):
    p = H.Params()
    net, f = H.Labeller(p), H.Features(p)
    net.fit(*H.training_set([h for _, _, h in site], p), f)
    rng, right = np.random.default_rng(77), 0
    texts = [b.text for _, _, h in site for b in H.blocks(h)]
    for k in range(100):
        html, said = H.skeleton([words(k + j, 15) for j in range(4)], texts, rng)
        own = H.blocks(html)
        right += [b.text for b, q in zip(own, net.probabilities([own], f)[0]) if q >= 0.5] == said
    assert right >= 90


def test_all_ancestors_and_all_words_reach_the_labeller():
    wrap = "".join(f'<div class="{" ".join(f"u{chr(97 + k)}{chr(97 + j)}" for j in range(14))}">' for k in range(4))
    (kept, comment) = H.blocks(f'<article><p>one</p><section class="comments">{wrap}two</div></div></div></div></section></article>')
    assert "article" in comment.path and ".comments" in comment.path and len(comment.path) > 64 and comment.path[-1] == ".udn"
    assert H.silver([kept, comment]).tolist() == [True, False]
    deep = H.blocks("<article>" + "".join(f'<div class="{"abcdefghij"[k % 10] * (1 + k // 10)}">x' for k in range(3000)))
    assert len(deep) == 3000 and all("article" in b.path for b in deep) and len(deep[-1].path) <= 64 + H.Params.paths + len(H.LABEL_NAMES)
    (long,) = H.blocks("<p>" + "same " * 200 + "end</p>")
    (_, (words,), _) = H.Features(H.Params()).of([long])
    assert len(words) == 201 and words[-1] != words[0]
