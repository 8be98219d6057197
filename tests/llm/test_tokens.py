"""Token counts and byte-level BPE against the tokenizers' own libraries."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from veilspark.llm.bpe import Bpe, bpe_round_trip
from veilspark.llm.segments import segments
from veilspark.llm.token_counts import token_counts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "\n\n  \n a", "it's we'll I'M 12 345abc", "a  b   c \t d\r\n e", "été naïve Ünï 北京 東京都  ñ",
    "x" * 3000 + " " * 700 + "y", "<|endoftext|> and a<|endoftext|>b", "tab\tnbsp x\x85y\x1cz   end ",
    "emoji 🙂🙂 👩‍👩‍👧 ok", "The cat sat. " * 50, "The cat sat. " * 50, "\u0000\u0001", "!!! ??? ... --- ***",
]


def randoms(n=300):
    rnd = random.Random(3)
    chars = "ab \n\t \x85\x1c'sé北9.!<|>endoftx 🙂​ "
    return ["".join(rnd.choice(chars) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_segments_lose_nothing():
    for t in [t or "" for t in TEXTS] + randoms(2000):
        assert "".join(segments(t)) == t


def test_bpe(spark, docs, library):
    texts = TEXTS + randoms()
    got = bpe_round_trip(docs(texts), RANKS, P.PATTERN, outputs=("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == text.encode()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_documents(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    for r in bpe_round_trip(df, RANKS, P.PATTERN, keep=["doc_id"], outputs=("ids", "decoded")).collect():
        assert r.ids == library.encode_ordinary(texts[r.doc_id]) and bytes(r.decoded).decode() == texts[r.doc_id]


def test_long_piece(library):
    rnd = random.Random(1)
    piece = "".join(rnd.choice("etaoinshrdlu") for _ in range(20000))
    bpe = Bpe(RANKS, P.PATTERN)
    assert bpe.merge([piece.encode()])[0].tolist() == library.encode_ordinary(piece)


def test_counts(spark, docs):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = TEXTS + randoms()
    got = token_counts(docs(texts), P.path("byte_bpe_50k.json")).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert r.n_tokens == n and r.n_bytes == len((texts[r.doc_id] or "").encode()) and r.over_limit == (n > 512)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_other_models(spark, docs, name):
    texts = TEXTS[:12]
    got = {r.doc_id: r.n_tokens for r in token_counts(docs(texts), P.path(name)).collect()}
    if name.endswith(".json"):
        tok = Tokenizer.from_file(P.path(name))
        want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in texts]
    else:
        import sentencepiece

        want = [len(sentencepiece.SentencePieceProcessor(model_file=P.path(name)).encode(t or "")) for t in texts]
    assert [got[i] for i in range(len(texts))] == want


def test_clashing_and_empty(spark, docs):
    df = docs(["a b", None]).withColumnRenamed("source", "n_tokens").withColumnRenamed("lang", "ids")
    assert token_counts(df, P.path("byte_bpe_50k.json")).count() == 2
    assert bpe_round_trip(df, RANKS, P.PATTERN).count() == 2
    assert token_counts(df.limit(0), P.path("byte_bpe_50k.json")).count() == 0
    assert bpe_round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0
