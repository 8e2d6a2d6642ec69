"""The merges of a sentencepiece model against the library."""

import hashlib
import random

import numpy as np
import pytest

from millrace.llm import sentencepiece_bpe
from millrace.llm.queries import tokenizer
from millrace.llm.sentencepiece_bpe import Pieces

PATH = tokenizer("piece_bpe_32k.model")
PARTS = ["a", "b", "e", "t", "h", " ", "  ", "▁", "\n", "é", "日", "\U0001F600", "\x00", "<s>", "</s>", "<unk>", "<0x41>",
         "1", "2", ".", "的", "ing", "́", "�", "\t", " ", "\r", "the", "ʼ"]


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def numbers(packed):
    return np.frombuffer(packed, dtype=np.int32).tolist()


def test_ids_are_those_of_the_library(pieces):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(4000)]
    assert list(map(numbers, pieces.encode(texts))) == pieces.library.encode(texts)


def test_long_text_without_spaces(pieces):
    rng = random.Random(2)
    for text in ("a" * 5000, "ab" * 3000, "".join(rng.choice("abcdefgh") for _ in range(20000)), "é日" * 2000, " " * 3000):
        assert numbers(pieces.encode([text])[0]) == pieces.library.encode(text)


def test_texts_of_any_ids_are_those_of_the_library(pieces):
    rng = random.Random(3)
    for _ in range(8000):
        ids = [rng.choice([0, 1, 2, rng.randrange(259), rng.randrange(131, 259), rng.randrange(32000), 28705, 259, 264])
               for _ in range(rng.randrange(1, 9))]
        assert pieces.decode(np.array(ids, dtype=np.int32)).decode() == pieces.library.decode(ids)


def test_a_full_memo_changes_nothing(pieces, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "MEMO_BYTES", 2000)
    small, rng = Pieces(PATH), random.Random(4)
    for _ in range(200):
        text = " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 9))) for _ in range(30))
        assert numbers(small.encode([text])[0]) == pieces.library.encode(text)
        assert small.held <= 1000 and len(small.memo) + len(small.older) < 200


def test_short_and_long_chunks_merge_alike(pieces):
    rng = random.Random(5)
    chunks = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    side = pieces.side_by_side.encode(chunks)
    assert side == {c: pieces.chunk(c) for c in chunks}
    # a character outside all pieces is spelled in bytes, whatever its place
    assert numbers(pieces.side_by_side.encode(["\U000E0001"])["\U000E0001"]) == pieces.library.encode("\U000E0001")[1:]


def test_other_kinds_of_files_are_an_error(tmp_path, pieces):
    # field 2 is the trainer, its field 3 the kind of model: 1 is a unigram model
    model = bytes(pieces.library.serialized_model_proto())
    other = tmp_path / "unigram.model"
    other.write_bytes(model + b"\x12\x02\x18\x01")
    with pytest.raises(ValueError, match="merges"):
        Pieces(str(other))


def test_frames(spark, docs, nothing, pieces):
    rows = docs.withColumnRenamed("node", "IDS").withColumnRenamed("quality_report", "decoded__")
    encoded = sentencepiece_bpe.encode(rows, PATH, check="as_library")
    assert encoded.columns == ["doc_id", "text", "lang", "source", "decoded__", "ids", "as_library"]
    decoded = sentencepiece_bpe.decode(encoded, PATH)
    assert decoded.columns == [*encoded.columns, "decoded"]
    found = decoded.collect()
    assert len(found) == docs.count()
    for r in found:
        assert r.as_library and r.ids == pieces.library.encode(r.text or "")
        assert r.decoded == (r.text or "") and r.decoded__ == "taken"
    empty = sentencepiece_bpe.decode(sentencepiece_bpe.encode(nothing, PATH), PATH)
    assert empty.count() == 0 and empty.columns[-2:] == ["ids", "decoded"]
    none = sentencepiece_bpe.decode(spark.createDataFrame([(1, None)], "a int, ids array<int>"), PATH)
    assert none.first().decoded == ""


def test_query(spark, data):
    from millrace.llm.queries import QUERIES

    library = Pieces(PATH).library
    want = {}
    for r in spark.read.parquet(f"{data}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(library.decode(ids).encode()).hexdigest(), True)
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_sentencepiece"](spark, data).collect()}
    assert got == want
