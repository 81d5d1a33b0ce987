import hashlib
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from churnwatch.llm import pieces, queries
from tests.conftest import SF01

CODEC = pieces.Codec(pieces.load_model())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
PARTS = ["a", "the", " the", "ing", " ", "  ", "▁", "\n", "\t", "é", "漢", "😀", "ﬁ", "㍿", "Å", "Å", "　", "\xa0", "１", "\x00", "<s>", "<0x41>", "�", "ｶﾞ", "½", "​", "́", "", "𝔘"]


def same(codec, library, text):
    ids, begins, ends = (a.tolist() for a in codec.encode(text))
    want = library.encode(text, return_type="proto").pieces
    assert ids == [p.id for p in want], text
    assert (begins, ends) == ([p.begin for p in want], [p.end for p in want]), text
    assert codec.decode(ids) == library.decode(ids), text


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=4)), max_size=12))
def test_pieces_spans_and_text_are_those_of_the_library(parts):
    same(CODEC, LIBRARY, "".join(parts).encode("utf-8", "ignore").decode())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 258), st.integers(0, 31_999), st.sampled_from([*map(CODEC.model.pieces.index, ("▁", "▁▁", "▁the")), 0, 1, 2])), max_size=8))
def test_any_ids_decode_as_in_the_library(ids):
    assert CODEC.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("dummy", [True, False])
@pytest.mark.parametrize("remove", [True, False])
def test_compiled_character_maps(tmp_path, rule, dummy, remove):
    """The same pieces under other rules: their maps replace, drop and compose characters."""
    from sentencepiece import sentencepiece_model_pb2 as models

    made, spec = models.ModelProto(), models.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        made.ParseFromString(f.read())
    spec.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    made.normalizer_spec.precompiled_charsmap = spec.normalizer_spec.precompiled_charsmap
    made.normalizer_spec.add_dummy_prefix, made.normalizer_spec.remove_extra_whitespaces = dummy, remove
    path = str(tmp_path / "other.model")
    with open(path, "wb") as f:
        f.write(made.SerializeToString())
    codec, library, rng = pieces.Codec(pieces.load_model(path)), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(5)
    for _ in range(400):
        same(codec, library, "".join(rng.choice(PARTS) for _ in range(rng.randrange(14))))
    made.pieces[500].type = 4  # user-defined
    with open(path, "wb") as f:
        f.write(made.SerializeToString())
    with pytest.raises(ValueError):
        pieces.load_model(path)


def test_long_runs_and_repeats():
    rng = random.Random(1)
    for text in ("x" * 50_000, " " * 3_000 + "a", "".join(rng.choice("abcdeé漢") for _ in range(20_000)), "word " * 20_000):
        same(CODEC, LIBRARY, text)


def test_query_matches_the_library(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op12_piece_spans(spark, SF01).collect()}
    assert len(got) == len(docs)
    spans = {}
    for d in docs:
        ids, found = LIBRARY.encode(d.text or ""), LIBRARY.encode(d.text or "", return_type="proto").pieces
        spans[d.doc_id] = [p.begin for p in found], [p.end for p in found]
        want = len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), LIBRARY.decode(ids)))
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want
    hashed = spark.createDataFrame([(k, *v) for k, v in spans.items()], "doc_id long, b array<int>, e array<int>").selectExpr("doc_id", "xxhash64(b, e) as h")
    assert {r.doc_id: r.h for r in hashed.collect()} == {k: r.spans_xxh64 for k, r in got.items()}


def test_columns_and_empty_rows(spark):
    df = spark.createDataFrame([(1, None, 5, "x"), (1, None, 5, "x"), (None, "", 6, None), (2, " a  b", 7, "y")], "doc_id long, text string, ids int, decoded string")
    made = pieces.encode(df, df.columns)
    assert made.columns == ["doc_id", "text", "decoded", "ids", "begins", "ends"]
    found = sorted(((r.doc_id or 0, r.ids, r.decoded) for r in pieces.decode(made).collect()), key=str)
    assert found == sorted([(1, [], ""), (1, [], ""), (0, [], ""), (2, LIBRARY.encode(" a  b"), " a  b")], key=str)
    both = pieces.encode(df, ["doc_id", "Decoded"], decoded="decoded")
    assert both.columns == ["doc_id", "ids", "begins", "ends", "decoded"] and sorted(r.decoded for r in both.collect()) == ["", "", "", " a  b"]
    assert pieces.encode(df.limit(0), ["doc_id"]).count() == 0
    assert pieces.decode(spark.createDataFrame([(None,)], "ids array<int>")).first().decoded == ""
