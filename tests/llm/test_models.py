"""Page extraction, nearest neighbours and chat logs."""

import numpy as np
import pytest

from millrace.llm import ann, chat, html_text


def page(lines, extra=""):
    body = "".join(f"<p>{x}" for x in lines)
    return (f"<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href='/a'>Home</a></li></ul></nav>"
            f"<div class='ad'>Buy this now.</div><article><h1>{lines[0]}</h1>{body}</article>{extra}<footer>&copy; us &amp; all</footer></body></html>")


def test_blocks():
    blocks = html_text.blocks_of("<p>a &amp; b<br>c<p><b>d\n e</b><script>x<y</script><div id='Side bar'>f<a href=x>g</a></div>tail")
    assert [b.text for b in blocks] == ["a & b c", "d e", "fg", "tail"]
    assert blocks[2].path == ("div", ".side", ".bar") and blocks[2].links == 1
    assert html_text.blocks_of(None) == html_text.blocks_of("") == []


def test_main_text(spark):
    rng = np.random.default_rng(0)
    words = [f"word{i}" for i in range(300)]
    lines = [[" ".join(rng.choice(words, rng.integers(4, 30))) + "." for _ in range(rng.integers(1, 9))] for _ in range(60)]
    rows = [(i, f"u{i}", page(x), "clash") for i, x in enumerate(lines)] + [(98, "u", None, ""), (99, "u", "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.with_main_text(df, training=html_text.Training(epochs=8))
    assert got.columns == ["page_id", "url", "html", "text"]
    texts = {r.page_id: r.text for r in got.collect()}
    assert texts[98] == texts[99] == ""
    right = sum(texts[i] == "\n\n".join([x[0], *x]) for i, x in enumerate(lines))
    assert right >= 57


def test_labels_of_layouts_held_out():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(200)]
    lines = lambda: [" ".join(rng.choice(words, rng.integers(5, 25))) for _ in range(rng.integers(2, 8))]
    model = html_text.train([page(lines()) for _ in range(96)])
    pages = html_text._layouts([lines() for _ in range(100)], rng)
    found = np.concatenate(html_text.label_pages(model, [b for b, _ in pages]))
    assert (found == np.concatenate([y for _, y in pages])).mean() > 0.95


def test_neighbours_find_nearly_all(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((3000, 16)).astype(np.float32)
    vectors[100:400] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    odd = [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] + [1.0] * 15), (5003, [1.0, 2.0]), (5004, [None] + [1.0] * 15), rows[7]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.neighbours(df, df.filter("vec_id % 20 = 0"), search=ann.Search(sample_rows=1000, leaf_rows=40)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == list(range(0, 3000, 20))
    v, hits = vectors.astype(float), 0
    for q, found in got.items():
        scores = (v * v[q]).sum(axis=1)
        scores[q] = -np.inf
        best = np.lexsort((np.arange(3000), -np.round(scores, 9)))[:20]
        hits += len(set(best.tolist()) & {i for _, i, _ in found})
        assert [r for r, _, _ in sorted(found)] == list(range(1, 21))
        assert all(s == pytest.approx(scores[i], abs=1e-12) for _, i, s in found)
    assert hits >= 0.9 * 20 * len(got)
    few = df.filter("vec_id < 5")
    assert ann.neighbours(few, few).groupBy("query_id").count().filter("count != 4").count() == 0
    assert ann.neighbours(df.filter("false"), df).count() == 0


def test_an_id_takes_one_place_and_small_leaves_are_not_enough(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300) for _ in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    once = {}
    for i, v in rows:
        once[i] = min(once.get(i, v), v)
    v = np.array([once[i] for i in range(300)])
    for r in ann.neighbours(df, df.filter("vec_id % 20 = 0")).collect():
        assert r.score == pytest.approx(v[r.query_id] @ v[r.vec_id], abs=1e-12)
    # clusters with fewer members than neighbours asked for
    centres = rng.standard_normal((80, 8)) * 50
    points = np.concatenate([c + rng.standard_normal((150 if i < 40 else 4, 8)) for i, c in enumerate(centres)])
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = ann.neighbours(df, df.filter("vec_id % 9 = 0"), search=ann.Search(leaf_rows=30, sample_rows=2000))
    assert {r["count"] for r in got.groupBy("query_id").count().collect()} == {20}
    assert got.groupBy("query_id", "vec_id").count().filter("count > 1").isEmpty()


def test_best_rows_with_many_ties():
    rng = np.random.default_rng(6)
    vectors = np.repeat(rng.standard_normal((30, 8)), 20, axis=0)
    ids, asked = rng.permutation(600), np.array([3, 700, 44])
    queries = rng.standard_normal((3, 8))
    allowed = rng.random((3, 600)) < 0.7
    query, row, score = ann._best(asked, queries, ids, vectors, 5, allowed)
    for i in range(3):
        exact = (vectors * queries[i]).sum(axis=1)
        own = [j for j in range(600) if allowed[i, j] and ids[j] != asked[i]]
        want = sorted(own, key=lambda j: (-exact[j], ids[j]))[:5]
        assert row[query == i].tolist() == want and score[query == i].tolist() == [exact[j] for j in want]


def test_bins_hold_whole_small_leaves():
    rows = {1: 10, 2: ann.CHUNK_ROWS, 5: 3, 6: 4, 7: 3 * ann.CHUNK_ROWS - 1, 9: 1}
    assert ann.bins_of(rows) == [(1, 0, 1), (2, 1, 1), (5, 2, 1), (6, 2, 1), (7, 3, 3), (9, 6, 1)]


def test_log_is_folded(spark):
    log = spark.createDataFrame([
        (1, 1, "start", 0, "user", "hi"), (1, 2, "start", 1, "assistant", None), (1, 3, "delta", 1, None, "wr"),
        (1, 3, "delta", 1, None, "wr"), (1, 4, "delta", 1, None, "ong"), (1, 5, "start", 2, "user", "then"),
        (1, 6, "regenerate", 1, None, None), (1, 7, "delta", 1, None, "right"), (1, 8, "edit", 0, None, "hello"),
        (1, 9, "delta", 0, None, "!"), (1, 10, "start", 2, "user", "next"), (1, 11, "noise", 2, "x", "y"),
        (2, 1, "delta", 0, None, "alone"), (None, None, "start", None, None, None)],
        "conv_id long, seq long, kind string, message long, role string, text string")
    got = {(r.conv_id, r.message): (r.role, r.text) for r in chat.replay(log).collect()}
    assert got == {(1, 0): ("user", "hello!"), (1, 1): ("assistant", "right"), (1, 2): ("user", "next"),
                   (2, 0): ("", "alone"), (None, None): ("", "")}
    assert chat.render(chat.replay(log.filter("false"))).count() == 0


def test_format_is_read_back(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\l\\e<\\", "", "a\nb\n", "\\\\n[<s>", "é😀<"]
    rows = [(c, i, role, t) for c, shift in ((1, 0), (2, 3)) for i, (role, t) in enumerate(
        zip(["user", "assistant", "as\nsist<", "assistant", "", "assistant"], nasty[shift:] + nasty[:shift]))]
    messages = spark.createDataFrame(rows, "conv_id long, message int, role string, text string")
    formatted = chat.render(messages)
    for r in chat.read_back(formatted).collect():
        own = [(role, t) for c, _, role, t in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.turns] == own
        assert "".join(r.loss) == "".join(t for role, t in own if role == "assistant")
    for r in formatted.collect():
        assert r.formatted.count("</s>") == len(r.turns) == 6
        assert all(r.formatted[t.begin:].startswith("<s>") for t in r.turns)


def test_native_plan(spark, data, plan_of):
    from millrace.llm.queries import QUERIES
    assert "Python" not in plan_of(QUERIES["op10_chat_formatting"](spark, data))
    assert "Python" not in plan_of(QUERIES["op1_quality_rules"](spark, data))


@pytest.mark.parametrize(("html", "want"), [
    ("<html><head><title>x</title><body><p>One<p>Two", ["One", "Two"]),
    ("<head><meta charset=utf-8><title>x</title><div>One</div>", ["One"]),
    ("<head><title>x</title>One<p>Two", ["One", "Two"]),
    ("<head><noscript><div>no</div></noscript><title>x</title></head><p>One</p>", ["One"]),
    ("<head><template><p>no</p></template><body><p>One</p>", ["One"]),
    ("<body><button>no<p>One</p><p>Two</p></body>", ["One", "Two"]),
    ("<body><div><select><option>no<option>no<p>One</div><p>Two", ["One", "Two"]),
    ("<body><object data=x>no<p>One</p><svg><path d=m><p>Two</p><button>no</button>", ["One", "Two"]),
    ("<body><button><div>no</div></button><object><p>no</p></object><p>One</p>", ["One"])])
def test_end_tags_left_out(html, want):
    assert [b.text for b in html_text.blocks_of(html)] == want
