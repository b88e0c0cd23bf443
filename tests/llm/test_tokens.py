"""Operators 2 and 10 against the libraries they have to match."""

import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terralist.llm import byte_bpe, piece_count
from terralist.llm.transducer import Transducer, joined

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
MODEL = piece_count.read_model(public_tokenizers.path("piece_bpe_32k.model"))
ENCODER = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
COUNTER = piece_count.Counter(MODEL)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.parsed(RANKS), special_tokens={})
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'aeinst12ABé漢😀▁-="), st.characters(exclude_categories=["Cs"])), max_size=80)


def ids(packed):
    return memoryview(packed).cast("I").tolist()


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_ids_are_the_librarys(text):
    assert ids(ENCODER.encode(text)) == LIBRARY.encode_ordinary(text)


@given(TEXTS, st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_counts_are_the_librarys_in_chunks_of_any_size(text, chunk):
    assert COUNTER.count(text, chunk) == len(PIECES.encode(text))


@pytest.mark.parametrize("text", ["a" * 3000, " " * 500, "ab" * 900 + " c", "\n" * 77, "<s>x</s><unk><0x0A>", "漢字" * 400])
def test_runs(text):
    assert ids(ENCODER.encode(text)) == LIBRARY.encode_ordinary(text)
    assert COUNTER.count(text, 100) == COUNTER.count(text) == len(PIECES.encode(text))


def test_transducer_on_random_vocabularies():
    rng = random.Random(5)
    for _ in range(60):
        ranks, tokens = {"a": -1, "b": -1, "c": -1}, ["a", "b", "c"]
        for rank in range(12):
            token = rng.choice(tokens) + rng.choice(tokens)
            if token not in ranks:
                ranks[token] = rank
                tokens.append(token)
        machine = Transducer(ranks, lambda t: (t,), (), max_states=20, max_pairs=10)
        for _ in range(60):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
            assert list(machine.run(text)) == joined(ranks, text)


@given(st.lists(st.binary(min_size=0, max_size=5), max_size=6))
@settings(max_examples=300, deadline=None)
def test_streamed_text_is_the_standards(parts):
    stream = byte_bpe.Utf8Stream()
    assert "".join(map(stream.feed, parts)) + stream.close() == b"".join(parts).decode("utf-8", "replace")


def test_any_cut_of_the_ids_decodes():
    text = "schön 漢字 😀 end"
    packed = ENCODER.encode(text)
    for block in range(1, 9):
        assert "".join(t for _, t in byte_bpe.decode_blocks(RANKS, packed, block)) == text


def test_odd_documents(odd, clashing, none):
    for docs in (odd, clashing):
        done = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS)
        names = ("text", "ids", "n_tokens", "decoded", "decoded_text")
        rows = done.select(*names).collect()
        together = byte_bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).select(*names).collect()
        assert sorted(map(tuple, together), key=repr) == sorted(map(tuple, rows), key=repr)
        assert len(rows) == odd.count()
        for r in rows:
            text = r["text"] or ""
            assert ids(bytes(r["ids"])) == LIBRARY.encode_ordinary(text)
            assert bytes(r["decoded"]) == text.encode() and r["decoded_text"] == text and r["n_tokens"] == len(r["ids"]) // 4
        # Texts over the bound go chunk by chunk; copies of them too.
        counted = piece_count.count_tokens(docs, MODEL, long=200, chunk=64).select("text", "n_tokens").collect()
        assert len(counted) == len(rows)
        for r in counted:
            assert r["n_tokens"] == len(PIECES.encode(r["text"] or ""))
    assert byte_bpe.encode(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert piece_count.count_tokens(none, MODEL).filter(F.col("n_tokens") > 0).count() == 0


def test_checked_ids_leave_the_text_behind(spark):
    texts = ["", None, "abc def 漢字 😀", "x" * 3000, "\x00 a  b\n"] * 3
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, own string")
    got = byte_bpe.checked_ids(df, RANKS, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "own", "ids", "n_tokens", "round_trip"]
    for r in got.collect():
        assert ids(r.ids) == LIBRARY.encode_ordinary(texts[r.doc_id] or "") and r.n_tokens == len(r.ids) // 4 and r.round_trip


def test_replaced_objects_are_released_first(monkeypatch):
    from terralist.llm import batches

    seen = []
    monkeypatch.setattr(batches, "_held", [None, None, None])
    monkeypatch.setattr(batches, "release", lambda: seen.append(batches._held[2]))
    assert [batches.held("a", 1, lambda: "x"), batches.held("a", 1, lambda: "y"), batches.held("b", 1, lambda: "z")] == ["x", "x", "z"]
    assert seen == [None]
    monkeypatch.undo()
    batches.release()


def test_repeated_passages_drop_what_another_operator_holds(monkeypatch):
    from terralist.llm import batches, suffix_dedup

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, task, schema):
            return task

    monkeypatch.setattr(batches, "_held", [None, None, None])
    batches.held("other", 1, list)
    assert list(suffix_dedup.anchor_rows(Docs(), 100, 16)(iter([]))) == [] and batches._held == [None, None, None]
