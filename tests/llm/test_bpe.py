import hashlib
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablemargin.llm import bpe
from tablemargin.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF_DIR = "/root/testdata/sf0.001"
ODD = ["", " ", "  a", "a  ", "a \n b", "\n\n\n", "don't I'LL we've", "naïve über ñandú ¿qué?", "日本語 テスト", "👩‍🔬 x",
       "<|endoftext|>", "a<|endoftext|> b", "\x1c \x85 x y", "é" * 40, "a" * 3000 + " " * 500 + "-" * 700, "½ ²³ Ⅷ ١٢"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_tokenizer(PATH))


def test_agrees_with_the_library_on_odd_texts(encoder, library):
    rng = random.Random(3)
    alphabet = [chr(c) for c in range(0x250)] + list(" \n\t'") * 30 + ["<|endoftext|>", "　", "‍", "\U0001F600"]
    texts = ODD + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == want, text
        assert encoder.decode(want) == library.decode(want, skip_special_tokens=False)


def test_incomplete_bytes_decode_to_replacement_characters(encoder, library):
    ids = encoder.encode("日本").tolist()[:1]
    assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False) == "�"


def test_no_token_spans_a_forced_cut(encoder):
    assert not any(encoder.cuts(token) for token in encoder.vocab)
    piece = " jardín¿ñú".encode()
    assert encoder.cuts(piece)


def test_long_and_short_fragments_merge_alike(encoder):
    rng = random.Random(5)
    for _ in range(300):
        ids = [encoder.byte_ids[b] for b in rng.choices(b" theanionry", k=rng.randint(1, 60))]
        assert encoder._scan(list(ids)) == encoder._heap(list(ids))


def test_caches_stay_bounded(library):
    small = bpe.Encoder(bpe.read_tokenizer(PATH))
    limit, bpe.CACHED = bpe.CACHED, 50
    try:
        text = " ".join(f"w{i % 170}x" for i in range(2000))
        assert small.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(small.words) <= 50 and len(small.words.old) <= 50
    finally:
        bpe.CACHED = limit


def test_nulls_empty_tables_and_clashing_columns(documents):
    df = documents([(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x")]).withColumn("token_ids", F.lit("old"))
    rows = bpe.encode_texts(df, PATH).orderBy("doc_id").collect()
    assert [len(r.token_ids) for r in rows] == [1, 0, 0, 2, 2] and rows[0].lang == "en"
    back = bpe.decode_ids(bpe.encode_texts(df, PATH), PATH)
    assert back.filter("decoded_text != coalesce(text, '')").count() == 0
    assert bpe.digests(df.limit(0), PATH).count() == 0


def test_query_against_the_library(spark, library):
    got = {r.doc_id: r for r in QUERIES["op1_bpe"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
