"""Operator 13 against the library it has to match."""

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from terralist.llm import piece_agenda, queries

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ENCODER, DECODER = piece_agenda.Encoder(MODEL, cached=50), piece_agenda.Decoder(MODEL)

TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'aeinst12ABé漢😀▁-=.,<>_"), st.characters(exclude_categories=["Cs"])), max_size=80)
IDS = st.lists(st.one_of(st.integers(0, 300), st.sampled_from([*LIBRARY.encode(" a"), 0, 1, 2]), st.integers(0, 31999)), max_size=12)


def ids(text):
    return memoryview(ENCODER.encode(text)).cast("i").tolist()


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_ids_and_text_are_the_librarys(text):
    assert ids(text) == LIBRARY.encode(text)
    assert DECODER.decode(ids(text)) == LIBRARY.decode(ids(text))


@given(IDS)
@settings(max_examples=300, deadline=None)
def test_any_ids_decode_as_the_librarys(numbers):
    assert DECODER.decode(numbers) == LIBRARY.decode(numbers)


@pytest.mark.parametrize("text", ["a" * 50_000, " " * 5000 + "x", "ab" * 900 + " c", "\n" * 77, "<s>x</s><unk><0x0A>", "漢字" * 400, "\x00▁ ▁a", " "])
def test_runs(text):
    assert ids(text) == LIBRARY.encode(text)


@given(st.text(alphabet="abc", max_size=40), st.lists(st.tuples(st.text(alphabet="abc", min_size=2, max_size=5), st.integers(0, 9)), max_size=25))
@settings(max_examples=300, deadline=None)
def test_agenda_takes_the_best_pair_and_the_leftmost_among_equals(text, scored):
    ranks, parts = dict(scored), list(text)
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            break
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    bounds = piece_agenda.merge(ranks, text)
    assert [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False)] == parts
    assert piece_agenda.merge_short(ranks, text) == parts


def test_odd_documents(odd, clashing, none):
    for docs in (odd, clashing):
        rows = piece_agenda.round_trip(docs, MODEL, check="same").select("text", "ids", "n_tokens", "decoded_text", "same").collect()
        assert len(rows) == odd.count()
        for r in rows:
            want = LIBRARY.encode(r["text"] or "")
            assert r["ids"] == want and r["n_tokens"] == len(want) and r["same"]
            assert r["decoded_text"] == LIBRARY.decode(want)
    apart = piece_agenda.decode(piece_agenda.encode(odd, MODEL), MODEL)
    assert apart.filter(F.col("decoded_text") != F.coalesce("text", F.lit(""))).count() == 0
    first, second = LIBRARY.encode("A"), LIBRARY.encode("b c")
    lists = odd.sparkSession.createDataFrame([([*first, None, *second],), (None,), ([],)], "ids array<int>")
    assert sorted(r[0] for r in piece_agenda.decode(lists, MODEL).select("decoded_text").collect()) == ["", "", "A b c"]
    assert piece_agenda.round_trip(none, MODEL).count() == 0


def test_query(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_piece_agenda"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = LIBRARY.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(want) and r["library_agrees"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(want).encode()).hexdigest()
