"""Token alignment against brute force over the libraries' tokens of whole texts."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from veilspark.llm import alignment
from veilspark.llm.alignment import Aligned, _tokens, alignment_scores, token_alignment
from veilspark.llm.sparse import csr, product, transposed

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "The quick brown fox, unbelievably, jumps over the lazy dog.", None, "", " ", "a", "\n", "  two  spaces \n\n  and\tone tab \n",
    "Grüße aus Köln: naïve café ﬁn 東京タワー 🙂🙃 x" * 3, "▁ is a mark", "plain ▁", "<|endoftext|> and <s> and </s> <0x41>",
    " " * 1500 + "x" + " " * 777, "no-break\u00a0space\u3000wide \x0b\x0c\x1c\x85 end", "ab" * 2000, "The quick brown fox, again.",
    "The quick brown fox, again.", "\t\tcode:\n\tif x:\n\t\treturn 1\n", "word\r\nword\r\n", "end\t x", "￿ \u2028 \u200b", "x\n", "\nx",
]


LIBRARIES: list = []


def tokens(text):
    """(id, begin, end) of both sides, or nothing."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    if not text:
        return [], []
    if not LIBRARIES:
        LIBRARIES.extend([Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)])
        LIBRARIES[0].encode_special_tokens = True
    a, sp = LIBRARIES
    inverse = alignment._byte_of()
    sides = []
    for pairs in (
        [(i, bytes(inverse[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids],
        [(i, bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
         for i in sp.encode(text)],
    ):
        side, at = [], 0
        for i, raw in pairs:
            side.append((i, at, at + len(raw)))
            at += len(raw)
        if b"".join(r for _, r in pairs) != (" " + text).encode():
            return [], []
        sides.append(side)
    return sides


def brute(texts):
    per, count = [], Counter()
    for text in texts:
        a, b = tokens(text)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        held = [([], []) for _ in ends]
        for s, side in enumerate((a, b)):
            for i, _, e in side:
                held[bisect_left(ends, e)][s].append(i)
        links = [(x, y) for left, right in held for x in left for y in right]
        overlaps = sum(x[1] < y[2] and y[1] < x[2] for x in a for y in b)
        written = [",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in held]
        per.append((len(a), len(b), len(ends), links, overlaps, ";".join(written)))
        count.update(set(links))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [
        (na, nb, ng, len(links), over, hashlib.sha256(w.encode()).hexdigest() if w else "",
         sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links))
        for na, nb, ng, links, over, w in per
    ]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "n_best", "count_sum")
SHORT = [t for t in TEXTS if t is None or len(t) < 1000]


@pytest.mark.parametrize("frequent", [500_000, 20, 0])
def test_equals_brute_force(spark, docs, frequent):
    """Whether the counts of a pair come by broadcast or by shuffle."""
    got = alignment_scores(docs(SHORT), A, B, keep=["doc_id"], frequent=frequent).collect()
    assert [tuple(r[n] for n in NAMES) for r in sorted(got, key=lambda r: r.doc_id)] == brute(SHORT)


def test_long_runs_without_common_ends():
    """Groups of thousands of tokens: links are counted by id, none is lost."""
    a, b = _tokens(A), _tokens(B)
    texts = [t for t in TEXTS if t and len(t) >= 1000]
    out = alignment._of_documents(texts, a, b)
    for i, t in enumerate(texts):
        want = brute([t])[0]
        assert [c[i] for c in out["counts"]] == list(want[:5])
        assert hashlib.sha256(out["groups"][i]).hexdigest() == want[5]
        assert out["n"][out["at"][i] : out["at"][i + 1]].sum() == want[3]


def test_parts_equal_whole_texts(monkeypatch):
    """Cutting texts and encoding many parts at a time changes nothing."""
    import duckdb

    a, b = _tokens(A), _tokens(B)
    assert a.cuts and b.cuts
    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall() if r[0]]
    cut = alignment._of_documents([*texts, *[t or "" for t in TEXTS]], a, b)
    monkeypatch.setattr(a, "cuts", False)
    whole = alignment._of_documents([*texts, *[t or "" for t in TEXTS]], a, b)
    assert cut["groups"] == whole["groups"]
    assert all((x == y).all() for x, y in zip(cut["counts"], whole["counts"], strict=True))
    assert all((cut[k] == whole[k]).all() for k in ("at", "pair", "n"))


def test_groups_written_out(docs):
    row = token_alignment(docs(["unbelievable"]), A, B, keep=["doc_id"], write_groups=True).first()
    a, b = tokens("unbelievable")
    assert [int(x) for g in row.groups.split(";") for x in g.split("|")[0].split(",")] == [i for i, *_ in a]
    assert [int(x) for g in row.groups.split(";") for x in g.split("|")[1].split(",")] == [i for i, *_ in b]
    assert sum(x.n for x in row.links) == row.n_links


def test_clashing_names_repeats_and_empty(spark, docs):
    df = spark.createDataFrame([("x y", 1, 2, 3, 4, 5), ("x y", 1, 2, 3, 4, 5), (None, 1, 2, 3, 4, 5)],
                               "text string, n_a int, _n_a int, rid int, links int, pair int")
    out = alignment_scores(df, A, B)
    assert out.columns[:5] == ["n_a", "_n_a", "rid", "links", "pair"] and "__n_a" in out.columns
    assert sorted(r["__n_a"] for r in out.collect()) == [0, 2, 2]
    assert alignment_scores(docs([]), A, B).collect() == []
    zero = alignment_scores(docs([None, "", "▁"]), A, B).collect()
    assert all(tuple(r[n] for n in NAMES) == (0, 0, 0, 0, 0, "", 0, 0) for r in zero)


def test_row_products():
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 3, (7, 9)), rng.integers(0, 3, (9, 5))
    sparse = [csr(*(np.repeat(i, m[m > 0]) for i in np.nonzero(m)), *m.shape) for m in (x, y)]
    for step in (1, 7, 10_000):
        got = product(*sparse, step=step)
        dense = np.zeros((7, 5), int)
        dense[got.row, got.index] = got.value
        assert (dense == x @ y).all()
    back = transposed(sparse[0])
    dense = np.zeros((9, 7), int)
    dense[back.row, back.index] = back.value
    assert (dense == x.T).all()


def test_no_parts():
    done = Aligned([], _tokens(A), _tokens(B))
    assert done.counts.shape == (5, 0) and done.groups == []
