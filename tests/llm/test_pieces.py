import os
import random
import re

import pytest

from folioflow.llm import pieces

PATH = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="the vocabulary is not here")


@pytest.fixture(scope="module")
def model():
    return pieces.load_model(PATH)


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The same pieces as a unigram model: its library encodes by Viterbi over the scores.

    The few pieces of score -1e9 get -40000, since the library adds scores in single precision.
    """
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        piece.score = max(piece.score, -40000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return pieces.load_model(str(path)), sentencepiece.SentencePieceProcessor(model_file=str(path))


def texts():
    rng = random.Random(4)
    words = ["the", "Theory", "naïve", "Straße", "日本語", "x==y;", "don't", "a  b", "\n", "\t", "🙂", "foo_bar(baz)", "1234.5", "…", "ééé", "  "]
    out = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    return out + [" lead", "trail ", "   ", "ꙮ" * 5, "supercalifragilisticexpialidocious" * 3, "\x00nul"]


def test_ids_are_the_library_s_and_read_back(spark, docs_frame, unigram):
    model, library = unigram
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: r for r in pieces.encode(docs_frame(rows), model, shard_bytes=1500).collect()}
    for i, text in rows:
        assert list(got[i]["ids"]) == library.encode(text), text
        assert got[i]["round_trip"] and got[i]["n_ids"] == len(got[i]["ids"])
    back = pieces.decode(spark.createDataFrame([(i, list(r["ids"])) for i, r in got.items()], "i bigint, ids array<int>"), model)
    assert {r["i"]: r["decoded"] for r in back.collect()} == dict(rows)


def test_cuts_cross_no_piece(model):
    for text in texts():
        for word in re.findall(f"{pieces.SPACE}+[^{pieces.SPACE}]*", pieces.SPACE + text.replace(" ", pieces.SPACE)):
            units = pieces.units_of(word, model.joined)
            assert "".join(units) == word
            for a, b in zip(units, units[1:]):
                assert a[-1] + b[0] not in model.joined


def test_edge_rows(docs_frame, model):
    rows = [(1, None, 1), (2, "", 2), (None, "a b", 3), (2, "", 2), (4, "▁ mark", 4)]
    df = docs_frame(rows, ", ids int").selectExpr("*", "1 AS digest", "2 AS _digest", "3 AS n_codes", "'x' AS unit")
    df = pieces.encode(df, model, carry=["doc_id", "ids", "digest", "_digest", "n_codes", "unit"])
    assert df.columns == ["doc_id", "digest", "_digest", "n_codes", "unit", "ids", "n_ids", "round_trip"]
    got = sorted((r["doc_id"] or 0, r["n_ids"] > 0, r["round_trip"]) for r in df.collect())
    assert got == [(0, True, True), (1, False, True), (2, False, True), (2, False, True), (4, True, False)]
    assert pieces.encode(docs_frame([]), model).collect() == []


def test_long_runs_without_spaces_have_the_library_s_ids(docs_frame, unigram):
    model, library = unigram
    rng = random.Random(8)
    rows = [
        "ab" * 1500, "-" * 3000, "=" * 513, " " * 1200, "x" * 512, "y" * 511, "abcdefghij" * 2000, "🙂ꙮ" * 700, "日本語" * 600,
        "".join(rng.choice("0123456789abcdef") for _ in range(20_000)), "".join(rng.choice("aeiounrst") for _ in range(6000)) + " end",
        "a" * 100_000, "-" * 100_000,
    ]
    got = {r["doc_id"]: r for r in pieces.encode(docs_frame(list(enumerate(rows))), model).collect()}
    for i, text in enumerate(rows):
        assert list(got[i]["ids"]) == library.encode(text), text[:20]
        assert got[i]["round_trip"]


def test_long_texts(docs_frame, model):
    rows = [(1, "word " * 60_000), (2, "abcdefghij" * 300)]
    got = {r["doc_id"]: r for r in pieces.encode(docs_frame(rows), model).collect()}
    assert got[1]["round_trip"] and got[2]["round_trip"]
