"""Quality rules, mixing, token counts, BPE and sharding on small inputs, against brute force."""

import hashlib
import random
import re
import struct
from collections import Counter, defaultdict

import pytest

from millrace.llm import bpe, mixing, quality, sharding, suffix_dedup, jaccard_join, token_counts

TOKENIZERS = "/opt/tokenizers"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated_words(words):
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    return len({i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)})


def test_quality_counts(docs):
    got = {r.doc_id: r.q for r in quality.with_quality(docs, into="q").select("doc_id", "q", "text").collect()}
    for r in docs.collect():
        text = r.text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        q = got[r.doc_id]
        assert (q.n_words, q.word_chars, q.n_dup_lines) == (len(words), sum(map(len, words)), len(lines) - len(set(lines)))
        assert q.n_symbols == sum(text.count(c) for c in "#*$%&|<>")
        assert q.n_repeat_words == repeated_words(words)
        assert q.base_failed == (len(words) < 10 or 100 * q.n_repeat_words > 20 * len(words))
        assert q.kept == (not q.broken) and not (q.base_failed and q.kept)
    # a column of the name asked for is replaced, others stay
    assert quality.with_quality(docs).columns == docs.columns
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_verdicts(spark):
    clean = " ".join(f"the word{i} of" for i in range(60))
    df = spark.createDataFrame([(1, clean), (2, clean.replace(" ", "# ")), (3, clean.replace(" ", "! ")),
                                (4, " ".join(f"{i}kx" for i in range(150))), (5, "too short"), (6, None)], "doc_id long, text string")
    assert [r.doc_id for r in quality.keep_good(df).collect()] == [1]
    with pytest.raises(ValueError):
        quality.with_quality(df, base=(), rules=())


def test_empty_tables(nothing):
    assert quality.keep_good(nothing).count() == 0
    assert mixing.mixed(nothing).count() == 0
    assert jaccard_join.with_components(nothing).count() == 0
    assert suffix_dedup.without_repeats(nothing).count() == 0
    path = f"{TOKENIZERS}/word_bpe_49k.json"
    assert bpe.decode(bpe.encode(nothing, path), path).count() == 0
    assert token_counts.with_token_count(nothing, f"{TOKENIZERS}/piece_bpe_32k.model").count() == 0
    assert sharding.with_shard(nothing, "doc_id", ["a", "b"], 101).count() == 0


def test_mix_meets_targets(docs):
    rows = mixing.with_copies(docs).select("doc_id", "source", "text", "mix.*").collect()
    again = mixing.with_copies(docs).select("doc_id", "mix.copies").collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    assert len(rows) == docs.count()
    by_source = defaultdict(list)
    for r in rows:
        assert r["size"] == len(WORD.findall(r.text or ""))
        assert 0 <= r.copies <= 3
        by_source[r.source].append(r)
    total = sum(r["size"] for r in rows)
    order = sorted(by_source, key=lambda s: (s is None, s))
    sizes = {s: sum(r["size"] for r in by_source[s]) for s in order}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weights[s] for s in order if s not in full)
        above = {s for s in order if s not in full and weights[s] * level > 3 * sizes[s]}
        if not above:
            break
        full |= above
    for s in order:
        target = 3 * sizes[s] if s in full else weights[s] * level
        assert by_source[s][0].target == pytest.approx(target)
        taken = sum(r["size"] * r.copies for r in by_source[s])
        assert abs(taken - target) <= max(r["size"] for r in by_source[s])
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)


@pytest.mark.parametrize("fallback", [True, False])
def test_token_counts_are_those_of_the_library(spark, docs, fallback):
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = token_counts.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model")
    if not fallback:
        vocabulary = [(p, s) for p, s in vocabulary if not re.fullmatch("<0x..>", p)]
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=fallback))
    library.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace()])
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc the▁\n\x85\x1cé梦ゼ𐍈<0x41>Ĝ") for _ in range(50)) for _ in range(400)]
    counter = token_counts.Counter(vocabulary)
    split = re.compile(f"[^{token_counts.WHITE}]+").findall
    assert [counter.text(t, split) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    if fallback:
        got = token_counts.with_token_count(docs, f"{TOKENIZERS}/piece_bpe_32k.model").collect()
        assert all(r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids) for r in got)


def test_bpe_is_that_of_the_library(docs):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    # a low bound sends texts through pieces and joins
    for bound in (32_768, 500):
        rows = bpe.decode(bpe.encode(docs, path, long_chars=bound), path).collect()
        assert len(rows) == docs.count()
        for r in rows:
            ids = library.encode(r.text or "", add_special_tokens=False).ids
            assert bytes(r.ids) == struct.pack(f"<{len(ids)}I", *ids)
            assert r.decoded == library.decode(ids, skip_special_tokens=False)


def test_bpe_joins(monkeypatch):
    from tokenizers import Tokenizer

    path = f"{TOKENIZERS}/word_bpe_49k.json"
    library, own = Tokenizer.from_file(path), bpe.Bpe(path)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    rng = random.Random(9)
    texts = ["".join(rng.choices("abcdeth", k=n)) for n in (10, 65, 700, 3000)] + ["a" * 777, "thein" * 300, "é!" * 200]
    texts += ["".join(rng.choices(list("abTHé's12!, \n") + ["<|endoftext|>", "'ll"], k=90)) for _ in range(300)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        pieces = [(*p, own.piece(*p)) for p in own.pieces(text)]
        assert bpe.unpack(own.joined(pieces)).tolist() == want == bpe.unpack(own.text(text)).tolist()


def test_shards(spark, docs):
    names = [f"n{i}" for i in range(12)]
    table = sharding.lookup_table(names, 1511)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1511)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 11)
    assert moved < 0.1 * 1511
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 7)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 8)
    keyed = spark.createDataFrame([("k", 1), ("k", 2), (None, 3), ("", 4)], "key string, shard long")
    placed = {r["n"]: r["s"] for r in sharding.with_shard(keyed.withColumnRenamed("shard", "n"), "key", names, 1511, "s").collect()}
    slot = lambda k: int(hashlib.md5(k.encode()).hexdigest()[:13], 16) % 1511
    assert placed == {1: names[table[slot("k")]], 2: names[table[slot("k")]], 3: names[table[slot("")]], 4: names[table[slot("")]]}
    assert sharding.with_shard(keyed, "key", names, 1511).columns == ["key", "shard"]
