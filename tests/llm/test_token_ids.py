"""Token-id files: exact round trips, the library's own ids, offsets and checksums."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import token_ids
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 40), st.integers(0, 2**32 - 1)), max_size=300), st.sampled_from([4, 64, 512]),
       st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_round_trip(ids, block, percentile):
    ids = np.array(ids, dtype=np.uint32)
    assert (token_ids.decode_file(token_ids.encode_file(ids, block, percentile)) == ids).all()


def test_blocks_have_exceptions_and_an_index():
    ids = np.array([7] * 500 + [50_000] * 12 + [9] * 100, dtype=np.uint32)
    data = token_ids.encode_file(ids)
    starts = np.frombuffer(data, "<u8", 3, 24)
    assert starts[-1] == len(data)
    assert np.frombuffer(data, "<u4", 1, int(starts[0]))[0] == 7
    assert tuple(np.frombuffer(data, "<u2", 2, int(starts[0]) + 4)) == (0, 12)
    assert len(data) < 4 * len(ids) / 10
    assert (token_ids.decode_file(data) == ids).all()
    with pytest.raises(ValueError):
        token_ids.decode_file(b"x" * 64)


TEXTS = ["", " ", "  two  spaces ", "a b", "tab\tand\n new  line\n\n", "naïve café – “quoted” text", "日本語 の 文章", "x y z",
         "it's we'll I'd", "a\x1cb \x1c c \x85 d", "<|endoftext|> in text", "under_score 12 345 6.7", "🎉 🎉🎉 a 🎉", "!? ... ;) (a) [b]", "w*** W!! x%%% don't' dogs' it's, 's 't a's",
         "été, ÉTÉ!! naïve*** straße.' ªº µm, x<|endoftext|> <|endoftext|>, y<| z|>"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_gives_the_library_ids(name):
    path = public_tokenizers.path(name)
    t, e = Tokenizer.from_file(path), token_ids.Encoder(path, kept=20)
    for _ in range(2):
        ids, sizes = e(pa.array(TEXTS))
        want = [x.ids for x in t.encode_batch(TEXTS, add_special_tokens=False)]
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab'é \t\n  　!1<|>中\x85\x1c"), max_size=25), min_size=1, max_size=4))
def test_encoder_on_any_blanks(texts):
    t, e = token_ids._encoder(PATH).tokenizer, token_ids.Encoder(PATH)
    ids, sizes = e(pa.array(texts))
    assert ids.tolist() == [i for x in t.encode_batch(texts, add_special_tokens=False) for i in x.ids]


def expected(rows):
    t = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, x in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query(spark):
    rows = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = QUERIES["op3_token_ids"](spark, SF).collect()
    assert sorted(tuple(r) for r in got) == expected(rows)


def test_edges(spark, tmp_path):
    rows = [(3, None), (1, ""), (2, "one two three " * 20_000), (-5, "minus"), (9, "same"), (9, "same"), (None, "no id")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, part int, start int")
    out = str(tmp_path / "ids")
    token_ids.write(df, PATH, out, parts=3, file_ids=50)
    want = expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)))
    got = sorted((tuple(r) for r in token_ids.digests(spark, out).collect()), key=lambda r: r[1])
    assert got == want
    whole = {(r.doc_id, r.start): r.ids for r in token_ids.read(spark, out).collect()}
    t = Tokenizer.from_file(PATH)
    assert [2] in whole.values()
    assert t.decode(whole[next(k for k in whole if k[0] == -5)][:-1]) == "minus"
    token_ids.write(df.limit(0), PATH, str(tmp_path / "none"))
    assert token_ids.digests(spark, str(tmp_path / "none")).collect() == []


def test_encoder_keeps_pieces_that_come_again():
    e, learned = token_ids.Encoder(PATH, kept=300), []
    keep = e._keep
    e._keep = lambda memo, pieces, *a, **k: (learned.extend(pieces), keep(memo, pieces, *a, **k))
    for i in range(30):
        texts = [f"so often, again {i}x{j} word{chr(97 + i % 26)}{chr(97 + j)}" for j in range(20)]
        ids, _ = e(pa.array(texts))
        assert ids.tolist() == [i for x in e.tokenizer.encode_batch(texts, add_special_tokens=False) for i in x.ids]
        assert len(e.spaced) + len(e.plain) <= 400
    assert learned.count("again") == learned.count("often,") == 1
    assert len(learned) > 1000


def test_encoder_holds_few_ids_as_objects():
    e, most = token_ids.Encoder(PATH), []
    ids_of = e._ids
    e._ids = lambda texts: (most.append(sum(map(len, texts))), ids_of(texts))[1]
    texts = [" ".join(f"é{i}" for i in range(40_000)), " ".join(f"n{i}" for i in range(40_000))]
    ids, sizes = e(pa.array(texts))
    assert ids.tolist() == [i for x in e.tokenizer.encode_batch(texts, add_special_tokens=False) for i in x.ids]
    assert max(most) < 100_000 < sum(most)
