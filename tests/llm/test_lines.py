"""Line dedup against brute force over all pairs of distinct lines."""

import random

from veilspark.llm import lines as L

SPACE = " \t\n\x0b\x0c\r"


def shingles(line):
    return {line} if len(line) < 5 else {line[i : i + 5] for i in range(len(line) - 4)}


def plain(texts, least=0.8):
    """Removed line numbers of each text, and the number of fuzzy links."""
    distinct = sorted({x.strip(SPACE) for t in texts for x in (t or "").split("\n")} - {""})
    up = {x: x for x in distinct}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    links = 0
    sets = [shingles(x) for x in distinct]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if len(a & b) >= least * len(a | b):
                links += 1
                up[find(distinct[i])] = find(distinct[j])
    seen, out = set(), []
    for t in texts:
        gone = []
        for k, x in enumerate((t or "").split("\n")):
            x = x.strip(SPACE)
            if x:
                root = find(x)
                if root in seen:
                    gone.append(k)
                seen.add(root)
        out.append(gone)
    return out, links


def corpus():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgé") for _ in range(rnd.randrange(2, 8)))
    base = [[word() for _ in range(rnd.choice([1, 3, 12, 30, 60]))] for _ in range(40)]
    solid = ["".join(rnd.choice("北京東西南上下左右中大小") for _ in range(80)) for _ in range(5)]
    texts = [None, "", "\n \n", "ab", "ab", "x\n\nx\n  x  "]
    for _ in range(80):
        out = []
        for _ in range(rnd.randrange(1, 7)):
            if rnd.random() < 0.1:
                s = list(rnd.choice(solid))
                s[rnd.randrange(80)] = "火"
                out.append("".join(s))
                continue
            w = list(rnd.choice(base))
            if rnd.random() < 0.5:
                w[rnd.randrange(len(w))] = word()
            out.append(rnd.choice(["", " "]) + " ".join(w))
        texts.append("\n".join(out))
    return texts


def test_brute_force(spark, docs):
    texts = corpus()
    want, links = plain(texts)
    got = {r.doc_id: r for r in L.line_report(docs(texts)).collect()}
    assert len(got) == len(texts) and links > 100
    for i, t in enumerate(texts):
        assert got[i].n_lines == sum(bool(x.strip(SPACE)) for x in (t or "").split("\n"))
    different = sum(got[i].removed != w for i, w in enumerate(want))
    assert different <= 2, different  # banding is not exact; equal and closest lines always are
    clean = {r.doc_id: r.text for r in L.without_repeated_lines(docs(texts)).collect()}
    for i, t in enumerate(texts):
        gone = set(got[i].removed)
        left = [x for k, x in enumerate((t or "").split("\n")) if k not in gone]
        if gone and not any(x.strip(SPACE) for x in left):
            assert i not in clean
        else:
            assert clean[i] == (t if t is None else "\n".join(left))


def test_recall(spark):
    """Pairs of lines at and above the threshold are found by the bands."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randrange(2, 9)))
    pairs = []
    while len(pairs) < 400:
        a = [word() for _ in range(40)]
        b = list(a)
        for _ in range(rnd.randrange(1, 5)):
            b[rnd.randrange(40)] = word()
        a, b = " ".join(a), " ".join(b)
        if len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)):
            pairs.append((a, b))
    texts = spark.createDataFrame([(t,) for p in pairs for t in p], "text string")
    found = L.verified(texts, L.candidates(L.signatures(texts)), 0.8).count()
    assert found >= 0.97 * len(pairs), found


def test_cases(spark, docs):
    long = " ".join(f"t{i}" for i in range(20_000))
    df = docs([(None, "one line here\nb"), (5, long), (4, long + "!"), (6, "one line here"), (6, "one line here")]).withColumnRenamed("lang", "removed").withColumnRenamed("source", "ids")
    got = L.line_report(df)
    assert got.columns == ["doc_id", "_removed", "_ids", "n_chars", "n_lines", "n_removed", "removed"]
    assert sorted((str(r.doc_id), r.n_removed) for r in got.select("doc_id", "n_removed").collect()) == [("4", 0), ("5", 1), ("6", 0), ("6", 1), ("None", 1)]
    clean = L.without_repeated_lines(df)
    assert clean.columns == df.columns and sorted(str(r.doc_id) for r in clean.collect()) == ["4", "6", "None"]
    assert L.line_report(df.limit(0)).count() == 0 and L.without_repeated_lines(df.limit(0)).count() == 0


def test_large_buckets_lose_no_pair(spark):
    """Pairs away from the hubs of a bucket are linked too, whatever the size of a tile."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    base = [[word() for _ in range(20)] for _ in range(30)]
    lines = [" ".join(w) for w in base] + [" ".join([*w[:-1], word()]) for w in base]
    texts = spark.createDataFrame([(x,) for x in lines], "text string")
    ids = [r.id for r in L._lines(texts).collect()]
    signed = spark.createDataFrame([(i, [1]) for i in ids], "id long, bands array<long>")
    met = L.buckets(signed)
    none = spark.createDataFrame([], "node long, root long")
    hubs = {tuple(r) for r in L.hub_pairs(met).collect()}
    for tile in (3, 1000):
        rest = [tuple(r) for r in L.open_pairs(met, none, tile).collect()]
        assert len(rest) == len(set(rest)) and not hubs & set(rest)
        assert hubs | set(rest) == {(a, b) for a in ids for b in ids if a < b}
    found = L.groups(texts, signed, 0.8)
    of = {r.node: r.root for r in found.collect()}
    assert all(of[ids[k]] == of[ids[k + 30]] == min(ids[k], ids[k + 30]) for k in range(30))
    joined = L.open_pairs(met, found)
    assert joined.filter("a = b").isEmpty()
    assert not {tuple(sorted((ids[k], ids[k + 30]))) for k in range(30)} & {tuple(r) for r in joined.collect()}


def test_sketches_spare_hopeless_pairs_and_lose_none(spark):
    """In one bucket of lines with a common half, only pairs that can be alike meet with their texts."""
    rnd = random.Random(17)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    half = [word() for _ in range(12)]
    lines = [" ".join(half + [word() for _ in range(12)]) for _ in range(120)]
    lines += [x[:-k] + "zz" for k, x in enumerate(lines[:40], 1)] + ["ab", "abcd", "ba " * 40, "aba " * 30]
    texts = spark.createDataFrame([(x,) for x in lines], "text string")
    found = L._lines(texts)
    text_of = {r.id: r.line for r in found.collect()}
    met = L.buckets(spark.createDataFrame([(i, [1]) for i in text_of], "id long, bands array<long>"))
    none = spark.createDataFrame([], "node long, root long")
    sketch = L.sketches(found)
    sizes = {r.id: r for r in sketch.collect()}
    assert all(sizes[i].n == len(shingles(t)) and sizes[i].spare >= 0 for i, t in text_of.items())
    every = {tuple(r) for r in L.open_pairs(met, none).collect()}
    alike = {(a, b) for a, b in every if len(shingles(text_of[a]) & shingles(text_of[b])) >= 0.8 * len(shingles(text_of[a]) | shingles(text_of[b]))}
    assert len(alike) > 10
    for tile in (7, 1000):
        left = {tuple(r) for r in L.open_pairs(met, none, tile, sketch, 0.8).collect()}
        assert alike <= left and len(left) < 0.02 * len(every)
    pairs = spark.createDataFrame(sorted(every), "a long, b long")
    assert {tuple(r) for r in L.reachable(pairs, sketch, 0.8).collect()} == left


def test_signatures_without_patterns(spark):
    """Shingles of signatures are cut by place: no pattern and no lambda in the plan, the same shingles as by
    patterns, in lines of any script and length."""
    rnd = random.Random(23)
    word = lambda: "".join(rnd.choice("abcdeéß北😀") for _ in range(rnd.randrange(1, 9)))
    lines = ["a", "é", "北京", "ab  c", "😀😀😀😀", "😀😀😀😀😀", "abcde", "abcdé", "x\ty", "北" * 400, "a" * 200, "* " * 70 + "*", "a " * 90 + "b"]
    lines += [" ".join(word() for _ in range(n)) for n in (1, 2, 5, 20, 30, 33, 40, 80, 300)]
    lines += [" ".join("abcdefgh"[: rnd.randrange(1, 9)] for _ in range(n)) + "  end" for n in (3, 25, 28, 35, 90)]
    texts = spark.createDataFrame([("\n".join(lines),), (None,), ("",), ("\n a \n",)], "text string")
    want = set()
    for x in lines:
        words = x.count(" ") + 1
        if len(x) <= L.SHORT or len(x) > 12 * words:
            want |= {(x, 0, s) for s in shingles(x)}
        if 0.8 * L.SHORT <= len(x) < 18 * words:
            w = x.split(" ")
            want |= {(x, 1, " ".join(w[i : i + 2])[:8]) for i in range(len(w))}
    text_of = {r.id: r.line for r in L._lines(texts).collect()}
    rows = L._shingle_rows(texts)
    assert {(text_of[r.id], r.kind, r.s) for r in rows.collect()} == want
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan and "lambda" not in plan


def test_only_open_buckets_are_sketched(spark, monkeypatch):
    """Buckets that the hubs join need no bitmaps, and links found later move roots, not all their lines."""
    rnd = random.Random(29)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    base = [word() for _ in range(40)]
    joined = [" ".join([*base[:-1], word()]) for _ in range(60)]  # alike to each other
    others = [[word() for _ in range(20)] for _ in range(30)]
    apart = [" ".join(w) for w in others] + [" ".join([*w[:-1], word()]) for w in others]
    texts = spark.createDataFrame([(x,) for x in joined + apart], "text string")
    id_of = {r.line: r.id for r in L._lines(texts).collect()}
    signed = spark.createDataFrame([(id_of[x], [1]) for x in joined] + [(id_of[x], [2]) for x in apart], "id long, bands array<long>")
    sketched, closed, sketches, connected = [], [], L.sketches, L.connected
    monkeypatch.setattr(L, "sketches", lambda lines: (sketched.append({r.id for r in lines.collect()}), sketches(lines))[1])
    monkeypatch.setattr(L, "connected", lambda edges: (closed.append(edges.count()), connected(edges))[1])
    of = {r.node: r.root for r in L.groups(texts, signed, 0.8).collect()}
    assert len(sketched) == 1 and sketched[0] <= {id_of[x] for x in apart}
    assert len(closed) == 2 and closed[1] <= 30
    assert {of[id_of[x]] for x in joined} == {min(id_of[x] for x in joined)}
    assert all(of[id_of[apart[k]]] == of[id_of[apart[k + 30]]] == min(id_of[apart[k]], id_of[apart[k + 30]]) for k in range(30))
    assert len(of) == 120
    roots = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node long, root long")
    more = spark.createDataFrame([(2, 6), (3, 4), (0, 9)], "a long, b long")
    monkeypatch.undo()
    assert {tuple(r) for r in L._joined(roots, more).collect()} == {(1, 1), (2, 1), (5, 1), (6, 1), (3, 3), (4, 3), (0, 0), (8, 0), (9, 0)}
