"""The pipeline stage by stage against brute force, at the smallest scale."""

import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from tests.llm.test_lines import SPACE, shingles as line_shingles
from tests.llm.test_jaccard import WORD, roots
from veilspark.llm.decontaminate import normal
from veilspark.llm.quality_rules import quality_verdicts
from veilspark.sources.stage import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Rows before the first stage and after each one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in C.STAGES:
        out.append(staged(stage(spark, out[-1], SF)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    for df in steps[:-1]:
        assert df.dtypes == steps[0].dtypes
    assert [n for n, _ in C.STAGES] == ["quality_rules", "line_dedup", "jaccard_join", "decontamination", "bpe"]


def test_quality(steps):
    kept = {r.doc_id for r in quality_verdicts(steps[0]).filter("kept").collect()}
    assert texts(steps[1]) == {d: t for d, t in texts(steps[0]).items() if d in kept} and 0 < len(kept) < steps[0].count()


def test_lines(steps):
    before, after = texts(steps[1]), texts(steps[2])
    seen, owner, up = {}, {}, {}
    for d in sorted(before):
        for x in before[d].split("\n"):
            x = x.strip(SPACE)
            if x and x not in seen:
                seen[x], owner[x] = line_shingles(x), d
    lines = list(seen)
    index = {}
    for i, x in enumerate(lines):
        for s in seen[x]:
            index.setdefault(s, []).append(i)
    edges = []
    for i, x in enumerate(lines):
        common = {}
        for s in seen[x]:
            for j in index[s]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        edges += [(i, j) for j, n in common.items() if n >= 0.8 * (len(seen[x]) + len(seen[lines[j]]) - n)]
    root = roots(len(lines), edges)
    up = {x: root[i] for i, x in enumerate(lines)}
    done, want = set(), {}
    for d in sorted(before):
        left = []
        for x in before[d].split("\n"):
            key = x.strip(SPACE)
            if not key or up[key] not in done:
                left.append(x)
            done.add(up.get(key))
        if any(x.strip(SPACE) for x in left) or not before[d].strip(SPACE):
            want[d] = "\n".join(left)
    different = {d for d in before if after.get(d) != want.get(d)}
    assert len(different) <= 2 and len(want) < len(before), different  # banding finds all but a few pairs near 0.8
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_jaccard(steps):
    before = texts(steps[2])
    ids = sorted(before)
    sets = []
    for d in ids:
        w = WORD.findall(before[d].lower() if before[d].isascii() else "".join(c.lower() if c.isascii() else c for c in before[d]))
        sets.append(({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}) if w else set())
    edges = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a and b and len(a & b) * 100 >= 80 * len(a | b)]
    want = {ids[i] for i in roots(len(ids), edges)}
    assert set(texts(steps[3])) == want


def test_decontamination(spark, steps):
    items = [normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(steps[3]), texts(steps[4])
    assert set(after) == {d for d, t in before.items() if not any(i in normal(t) for i in items)}


def test_tokens(steps):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = texts(steps[4])
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(before)
    for r in rows:
        assert r.ids == library.encode_ordinary(before[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(before[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    """Nulls, empty and repeated rows pass every stage."""
    rows = [(None, None, None, None, None), (None, "", "en", "s", 0), (1, "word " * 30, "en", "s", 1), (1, "word " * 30, "en", "s", 1)]
    rows += [(i, " ".join(f"w{i}x{k}" for k in range(60)), "en", "s", 9) for i in range(2, 40)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        df = docs.limit(0) if empty else docs
        for _, stage in C.STAGES:
            df = staged(stage(spark, df, SF))
        assert df.count() == (0 if empty else 38)
