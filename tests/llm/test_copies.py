"""Jaccard join, suffix-array dedup and the pipeline against brute force."""

import hashlib
import random
import struct
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from millrace.llm import jaccard_join, suffix_array, suffix_dedup
from millrace.llm.graph import components
from millrace.llm.suffix_array import equal_runs, suffix_ranks


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(s), label[i]) for i, s in sets.items()}


def brute_repeats(rows):
    seen, result = set(), {}
    for i, text in sorted(set(rows)):
        raw = (text or "").encode()
        covered, own = bytearray(len(raw)), set()
        for p in range(len(raw) - 99):
            s = raw[p:p + 100]
            if s in seen or s in own:
                covered[p:p + 100] = b"\1" * 100
            own.add(s)
        seen |= own
        result[i] = (sum(covered), bytes(b for b, c in zip(raw, covered) if not c),
                     sum(1 for k, c in enumerate(covered) if c and not (k and covered[k - 1])))
    return result


def test_components_of_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard_join.with_components(docs).collect()
    want = brute_components(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c}


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(9)
    line = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60))
    a, b, c, d, e, f = (line() for _ in range(6))
    big = 2 ** 53 + 1
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "x"), (2, a + " more", "x"),  # repeated, with a near copy
            (None, b, "x"), (None, b, "x"), (None, b + " more", "x"),  # only null ids
            (None, c + " more", "x"), (big, c, "x"),  # a set of null ids only, linked to an id
            (4, d, "x"), (4, e, "x"), (4, a + " other", "x"),  # one id, three texts, one of them near to another id
            (5, f, "x"), (5, f, "y"),
            (6, "", "x"), (6, None, "x"), (7, "", "x"), (None, " ", "x"), (None, " ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, further string").repartition(3)
    got = [(r.doc_id, r.component_id) for r in jaccard_join.with_components(df).collect()]
    want = [(1, 1)] * 3 + [(2, 1), (4, 1), (4, 4), (4, 4), (None, big), (big, big)] + [(None, None)] * 5 + [
        (5, 5), (5, 5), (6, 6), (6, 6), (7, 7)]
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = jaccard_join.keep_one(df).collect()
    texts = [(r.doc_id, (r.text or "").removesuffix(" more")) for r in kept]
    assert sorted(texts, key=str) == sorted([(1, a), (None, b), (big, c), (4, d), (4, e), (5, f), (6, ""), (7, ""), (None, " ")], key=str)


@pytest.mark.parametrize("cell_bytes", [1 << 24, 1 << 18])
def test_near_copies_just_beyond_the_threshold(spark, monkeypatch, cell_bytes):
    """Hundreds of sets a hair too far from each other, some in pairs: rows made grow with them, not with their square."""
    rng = random.Random(31)
    own = iter(range(10 ** 6))
    base = " ".join(f"b{i}" for i in range(34))
    rows = []
    for i in range(0, 600, 2):
        tail = [f"t{next(own)}" for _ in range(4)]
        rows.append((i, " ".join([base, *tail])))
        if rng.random() < 0.3:
            rows.append((i + 1, " ".join([base, *tail[:3], f"t{next(own)}"])))
    rows += [(1000 + i, f"{base} o{i} o o o") for i in range(20)]
    made, write = {}, jaccard_join.staged

    def counted(df, purpose):
        made[purpose] = made.get(purpose, 0) + (df := write(df, purpose)).count()
        return df

    monkeypatch.setattr(jaccard_join, "staged", counted)
    monkeypatch.setattr(jaccard_join, "CELL_BYTES", cell_bytes, raising=False)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.with_components(df).collect()}
    assert got == brute_components(rows)
    assert made["untried"] + made.get("groups", 0) + made.get("group-links", 0) <= 4 * len(rows)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    bands = jaccard_join.Bands()
    for _ in range(3000):
        size = int(rng.integers(4, 120)) if rng.random() < 0.7 else int(rng.integers(120, 900))
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        gone = int(rng.integers(0, len(a) // 5 + 1))
        b = np.delete(a, rng.choice(len(a), gone, replace=False))
        b = np.unique(np.append(b, rng.integers(0, 1 << 63, int(rng.integers(0, len(a) // 4 + 1)), dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if min(len(a), len(b)) >= 4 and 100 * both >= 80 * (len(a) + len(b) - both):
            assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))


def test_graph_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)]
    label = {n: n for pair in links for n in pair}
    for _ in range(60):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in label.items() if any(a != b and n in (a, b) for a, b in links)}


def test_repeats(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = suffix_dedup.without_repeats(docs).collect()
    want = brute_repeats(rows)
    assert len(got) == len(rows)
    for r in got:
        n, kept, spans = want[r.doc_id]
        assert (sum(s.end - s.begin for s in r.removed), bytes(r.kept), len(r.removed)) == (n, kept, spans)
    texts = suffix_dedup.with_kept_text(docs)
    assert texts.columns == docs.columns
    assert {r.doc_id: r.text for r in texts.collect()} == {i: k.decode("utf-8", "ignore") for i, (_, k, _) in want.items()}


def test_repeats_within_and_across_long_texts(spark):
    rng = random.Random(8)
    letters = lambda n, of="abcd ": "".join(rng.choices(of, k=n))
    shared = letters(150)
    rows = [(3, "xy" * 900), (1, letters(3000) + shared), (2, shared + letters(2000, "ab")), (9, "xy" * 500),
            (5, shared[:99]), (6, shared[:100]), (7, "\0" * 300), (8, letters(120) * 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats(rows)
    for r in suffix_dedup.without_repeats(df).collect():
        assert (sum(s.end - s.begin for s in r.removed), bytes(r.kept), len(r.removed)) == want[r.doc_id]


def test_repeats_of_every_period(spark):
    rng = random.Random(51)
    letters = lambda n: "".join(rng.choices("abcdefghij klmnop", k=n))
    rows = [(period * 10 + times, letters(rng.randrange(60)) + letters(period) * times + letters(rng.randrange(60)))
            for period in range(1, 101) for times in range(3, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats(rows)
    for r in suffix_dedup.without_repeats(df).collect():
        assert (sum(s.end - s.begin for s in r.removed), bytes(r.kept), len(r.removed)) == want[r.doc_id], r.doc_id


def test_a_repeat_across_slices_is_seen(monkeypatch):
    rng = random.Random(52)
    suffix_dedup._least_hashes(b"x" * 200)  # the powers for whole slices
    monkeypatch.setattr(suffix_dedup, "SLICE", 1024)
    letters = lambda n: bytes(rng.choices(range(97, 123), k=n))
    line = letters(51)
    for before in range(1024 - 60, 1024 + 10):
        h, starts, ends, again = suffix_dedup._stretches(letters(before) + (line * 3)[:151] + letters(900))
        # windows that are equal lie 51 apart, in one stretch that must be marked
        at = np.searchsorted(starts, [before, before + 51], side="right") - 1
        assert at[0] != at[1] or again[at[0]], before


@pytest.mark.parametrize("letters", [1, 2, 3, 200])
def test_suffix_order(letters):
    rng = random.Random(letters)
    for depth in (3, 5, 10, 20):
        for _ in range(25):
            text = b"\0".join(bytes(rng.choices(range(1, letters + 1), k=rng.randint(1, 60))) for _ in range(rng.randint(1, 8))) + b"\0"
            symbols = np.frombuffer(text, dtype=np.uint8)
            rank = suffix_ranks(symbols, depth)
            key = lambda i: text[i:min(text.index(b"\0", i) + 1, i + depth)]  # noqa: E731, B023
            in_order = [key(i) for i in sorted(range(len(text)), key=lambda i: rank[i])]
            assert in_order == sorted(in_order)
            starts = np.array([i for i in range(len(text)) if text.index(b"\0", i) - i >= depth], dtype=np.int64)
            classes = defaultdict(set)
            for i, c in zip(starts.tolist(), equal_runs(symbols, starts, depth).tolist()):
                classes[text[i:i + depth]].add(c)
            assert all(len(c) == 1 for c in classes.values()) and len({min(c) for c in classes.values()}) == len(classes)


def test_pipeline(spark, docs):
    """Each stage's rows from its input; the mix and the encoding are checked by their own tests."""
    import corpus_pipeline as pipeline
    from tokenizers import Tokenizer

    rows = docs.select("doc_id", "text", "lang", "source", docs.node.alias("n_chars")).distinct()
    stages = dict(pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_copies", "repeated_passages", "source_mix", "encoded"]
    good = stages["quality_rules"](spark, rows, "")
    apart = stages["near_copies"](spark, good, "")
    left = brute_components([(r.doc_id, r.text) for r in good.collect()])
    assert {r.doc_id for r in apart.collect()} == {i for i, (_, c) in left.items() if i == c}
    assert apart.count() == sum(i == c for i, (_, c) in left.items())
    assert stages["near_copies"](spark, good.union(good), "").count() == apart.count()
    cut = stages["repeated_passages"](spark, apart, "")
    want = brute_repeats([(r.doc_id, r.text) for r in apart.collect()])
    assert {r.doc_id: r.text for r in cut.collect()} == {i: k.decode("utf-8", "ignore") for i, (_, k, _) in want.items()}
    mix = stages["source_mix"](spark, cut, "")
    assert mix.columns == rows.columns
    library = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    texts = {r.doc_id: r.text for r in mix.collect()}
    coded = stages["encoded"](spark, mix, "").collect()
    assert len(coded) == mix.count()
    for r in coded:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())


def test_columns_named_like_those_in_between(spark):
    rows = [(1, "x" * 150, "a", "b", "c"), (2, "x" * 150, "a", "b", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans__ string, kept__ string, doc__ string")
    got = suffix_dedup.without_repeats(df).orderBy("doc_id").collect()
    assert [(r.spans__, r.kept__, r.doc__) for r in got] == [("a", "b", "c")] * 2
    # every string of 100 bytes but the first starts earlier, too
    assert [len(r.kept) for r in got] == [1, 0]


def test_the_scanner_sends_blocks_of_bounded_size():
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefgh ", k=200_000)) for _ in range(40)]
    frame = pd.DataFrame({"doc": range(40), "version": range(40), "text": texts})
    sent = [sum(len(h) // 4 for h in out["hashes"]) for out in suffix_dedup._scanner(4)(iter([frame]))]
    assert len(sent) > 1 and max(sent) <= 260_000 < sum(sent)


@pytest.mark.parametrize("top", [3, 1 << 20, 1 << 61])
def test_counts_of_smaller_keys(top):
    rng = np.random.default_rng(5)
    for n, cut in ((0, 0), (1, 0), (1, 1), (300, 120)):
        keys = rng.integers(0, top, n)
        first, rest = suffix_array._smaller(keys, cut)
        assert first.tolist() == [int((keys[:cut] < k).sum()) for k in keys]
        assert rest.tolist() == [int((keys[cut:] < k).sum()) for k in keys]


def test_suffixes_are_merged_by_sorting(monkeypatch):
    """A search for each suffix took more than half of the operator's time."""
    monkeypatch.setattr(np, "searchsorted", None)
    text = np.append(np.random.default_rng(6).integers(1, 3, 5000), 0)
    starts = np.arange(4000)
    rank = suffix_ranks(text, 50)[starts]
    windows = [text[i:i + 50].tolist() for i in np.argsort(rank, kind="stable")]
    assert windows == sorted(windows)


def test_small_groups_are_sorted_in_slices(monkeypatch):
    sizes, judged = [], suffix_dedup._judged
    monkeypatch.setattr(suffix_dedup, "_judged", lambda h, doc, version, start, size, pieces: (
        sizes.append(sum(map(len, pieces))), judged(h, doc, version, start, size, pieces))[1])
    rng = random.Random(7)
    texts = ["".join(rng.choices("abcdefgh ", k=20_000)) for _ in range(12)] * 2
    frame = pd.DataFrame({"doc": range(24), "version": range(24), "text": texts,
                          "nth": [[np.arange(len(suffix_dedup._stretches(t.encode())[0]), dtype=np.uint32).tobytes()] for t in texts]})
    sent = pd.concat(suffix_dedup._sender(1)(iter([frame.iloc[:12]]))), pd.concat(suffix_dedup._sender(1)(iter([frame.iloc[12:]])))
    found = suffix_dedup._sorted_windows(pd.concat(sent))
    assert len(sizes) > 1 and max(sizes) < 1 << 18
    # a copy's windows all start earlier in the first of the two
    assert sorted(found["doc"]) == list(range(12, 24))
    assert all(suffix_dedup._removed([x]) == [(0, 20_000)] for x in found["spans"])


def test_only_stretches_of_the_smallest_document_are_laid_out(monkeypatch):
    """A passage in many documents took a number for each of its windows in each of them."""
    laid, repeat = [], np.repeat
    monkeypatch.setattr(np, "repeat", lambda *a: (laid.append(repeat(*a)), laid[-1])[1])
    piece = bytes(random.Random(8).choices(range(97, 123), k=130))
    n = 5000
    doc = np.arange(n)[::-1] + 7
    row, first, last = suffix_dedup._judged(np.zeros(n, dtype=np.uint64), doc, doc, np.full(n, 40), np.full(n, 31), [piece] * n)
    assert max(map(len, laid)) < n
    assert sorted(zip(row.tolist(), first.tolist(), last.tolist())) == [(i, 40, 70) for i in range(n - 1)]
