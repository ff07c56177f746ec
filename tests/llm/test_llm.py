from __future__ import annotations

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chronopix.llm import ann, decontaminate, langid, lattice, licenses, mixing, quality, queries, simhash, tokens, toxicity
from tests.oracle import check, connect

#: Every other name that an operator gives a column of its own.
CLASH = "_row _kept _kept_row copies n_words n_hit items lang_score h hash features letters digest taken run copy own held_out label predicted least root component_id fingerprint".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, row string, word string, score string, spans string, prefix string, lang_pred string, toxicity string, " + ", ".join(f"{c} string" for c in CLASH)
LONG = " ".join(f"w{i % 977} lorem" for i in range(60_000))
EDGE = [
    (1, None, None, None), (2, "", "en", ""), (3, " \t\n\x0b", "en", "a"), (4, "one", "en", "a"), (5, "One  TWO", "fr", "b"), (6, "One  TWO", "fr", "b"), (6, "One  TWO", "fr", "b"), (None, "a b c d", None, None),
    (None, "a b c d", None, None), (7, LONG, "en", "a"), (8, "Ünï ćøde 漢字 <|endoftext|> x y's  \n\n z", "de", "c"), (9, "123 !!! ---", "en", "c"), (-3, "x" * 50_000, "es", "d"),
]


def docs(spark, rows=EDGE):
    return spark.createDataFrame([(i, t, l, s, len(t or ""), *["clash"] * (8 + len(CLASH))) for i, t, l, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def con():
    return connect("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(con):
    return con.sql("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, con, name):
    check(queries.queries()[name](spark, sf), con, queries.oracle_sql()[name])


# Nearest neighbours
def test_search_recall_and_scores(spark, con):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = e.collect()
    ids, m = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    asked = np.nonzero(ids % 50 == 0)[0]
    got = {}
    for r in queries.op1_permutation_search(spark, "/root/testdata/sf0.1").collect():
        got.setdefault(r["query_id"], []).append(r)
    hit = 0
    for q in asked:
        own = sorted(got[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5] and ids[q] not in [r["vec_id"] for r in own]
        s = m @ m[q]
        for r in own:
            assert r["score"] == pytest.approx(s[np.nonzero(ids == r["vec_id"])[0][0]], abs=1e-12)
        s[q] = -9
        hit += len({r["vec_id"] for r in own} & set(ids[np.argsort(-s)[:5]].tolist()))
    assert hit / (5 * len(asked)) >= 0.9


def test_search_edges(spark):
    v = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0, None]), (7, [-1.0, 0.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, [1e200, 1e200]), (9, [1e200, 1e200]), (10, [])]
    df = spark.createDataFrame([(i, x, "q", 1) for i, x in v], "vec_id bigint, embedding array<double>, query_id string, rank int")
    got = [tuple(r) for r in ann.search(df, df.where("vec_id = 0 or vec_id = 3")).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 9, pytest.approx(math.sqrt(0.5))), (0, 4, 7, -1.0)]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0 and ann.search(df, df.limit(0)).count() == 0


def _clustered(spark, n, d, clusters, spread):
    r = np.random.default_rng(4)
    centres = r.normal(size=(clusters, d))
    m = centres[r.integers(0, clusters, n)] + spread * r.normal(size=(n, d))
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id bigint, embedding array<double>"), m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.mark.parametrize("n,d,clusters,spread", [(6_000, 384, 60, 1.0), (6_000, 64, 1, 1.0)])
def test_search_over_many_cells_and_blocks(spark, monkeypatch, n, d, clusters, spread):
    """Recall where the index has 20 cells and more, met block by block; and everything is found where every cell is visited whole."""
    monkeypatch.setattr(ann, "CELL", 300)
    monkeypatch.setattr(ann, "QUERIES", 16)
    e, m = _clustered(spark, n, d, clusters, spread)
    asked = e.where("vec_id % 60 = 0")
    for exact, least in ((False, 0.9), (True, 1.0)):
        got = {}
        for r in ann.search(e, asked, exact=exact).collect():
            got.setdefault(r["query_id"], set()).add(r["vec_id"])
        hit = 0
        for q in range(0, n, 60):
            s = m @ m[q]
            s[q] = -9
            hit += len(got[q] & set(np.argsort(-s)[:5].tolist()))
        assert hit / (5 * len(got)) >= least and len(got) == n // 60


def test_search_of_a_crowded_cell_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 10)
    r = np.random.default_rng(2)
    near = [(i, (np.array([1.0, 0, 0]) + 0.01 * r.normal(size=3)).tolist()) for i in range(200)]  # most in one cell
    rows = near + [(1_000 + i, [0.0, 1.0, 0.0]) for i in range(300)] + [(i + 5_000, r.normal(size=3).tolist()) for i in range(30)]
    e = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [tuple(x) for x in ann.search(e, e.where("vec_id % 100 = 0"), exact=True).orderBy("query_id", "rank").collect()]
    m = np.array([x for _, x in rows])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ids, want = np.array([i for i, _ in rows]), []
    for q in np.nonzero(ids % 100 == 0)[0][np.argsort(ids[ids % 100 == 0])]:
        s = (m * m[q]).sum(axis=1)
        s[q] = -9
        want += [(ids[q], k + 1, ids[x], pytest.approx(s[x], abs=1e-12)) for k, x in enumerate(np.lexsort((ids, -np.round(s, 13)))[:5])]
    assert got == want


def test_footrule_matches_its_definition():
    rng = np.random.default_rng(1)
    orders = np.array([rng.permutation(12)[:5] for _ in range(40)], np.int16)
    place = lambda o: {int(p): i for i, p in enumerate(o)}
    for q, got in zip(orders[:6], ann.footrule(orders[:6], orders, 12), strict=True):
        a = place(q)
        for o, d in zip(orders, got, strict=True):
            b = place(o)
            assert d == sum(abs(a.get(p, 5) - b.get(p, 5)) for p in a.keys() | b.keys())


# Near-duplicates
def brute_fingerprint(text):
    from xxhash import xxh64_intdigest

    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", low) if x]
    if not w:
        return 0
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    n = len(rows)
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, k in itertools.combinations(range(n), 2):
        if (rows[i][1] ^ rows[k][1]).bit_count() <= 3:
            up[root(i)] = root(k)
    least = {}
    for i in range(n):
        if rows[i][0] is not None:
            least[root(i)] = min(least.get(root(i), rows[i][0]), rows[i][0])
    return [least.get(root(i)) for i in range(n)]


def test_fingerprints_and_components(spark, texts):
    rows = [(i, t, lang, s) for i, t, lang, s in texts] + EDGE
    want = [(i, brute_fingerprint(t)) for i, t, _, _ in rows]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(want, brute_components(want), strict=True)), key=repr)
    assert sorted(map(tuple, simhash.near_duplicates(docs(spark, rows)).collect()), key=repr) == want


def test_no_link_is_lost(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)} | {0, 2**64 - 1}
    chain = rng.getrandbits(64)
    for _ in range(60):  # a chain of near fingerprints, and clusters around a few
        for b in rng.sample(range(64), rng.randint(1, 3)):
            chain ^= 1 << b
        fps.add(chain)
    for c in rng.sample(sorted(fps), 5):
        for _ in range(40):
            x = c
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
            fps.add(x)
    rows = [(k, f) for k, f in enumerate(sorted(fps))]
    signed = lambda f: f - 2**64 if f >= 2**63 else f
    df = spark.createDataFrame([(k, signed(f)) for k, f in rows], "doc_id bigint, f0 bigint")
    got = {r["doc_id"]: r["component_id"] for r in simhash._labelled(df).collect()}
    assert [got[k] for k, _ in rows] == brute_components(rows)


def test_tables_go_with_their_scope_and_need_a_shared_folder(spark, sf, tmp_path, monkeypatch):
    import os

    from chronopix.llm import common

    monkeypatch.setattr(common, "shared_dir", lambda spark: str(tmp_path))
    corpus_pipeline.run(spark, sf).count()
    assert [x.split("-")[:2] for x in os.listdir(tmp_path / "chronopix")] == [["stage", "mixture"]]
    monkeypatch.undo()

    class Far:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: type("C", (), {"get": staticmethod(lambda _: None)}))

    with pytest.raises(RuntimeError):
        common.shared_dir(Far)


def test_columns_of_any_name_survive(spark, sf):
    d = docs(spark)
    mine = d.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, sf)
        assert out.columns == mine, name
        for r in out.collect():
            assert all(r[c] == "clash" for c in mine[5:]), name


def brute_wide(text, width=5):
    from xxhash import xxh3_128_digest

    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = {b" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}
    h = [int.from_bytes(xxh3_128_digest(x, 42) + xxh3_128_digest(x, 43), "little") for x in shingles]
    return sum(1 << b for b in range(256) if 2 * sum(x >> b & 1 for x in h) > len(h))


def jaccard(a, b, width=5):
    a, b = ({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def test_wide_fingerprints_and_near_copies(spark, texts):
    """Pairs of every similarity: most of 0.85 and more are found, few of 0.6 to 0.7 and none under, copies always; fingerprints are as by plain sums."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ala", "ero", "ini", "ost", "und")]
    rows, pairs = [], []
    for k in range(240):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(80, 400))]
        near = list(words)
        for _ in range(round(len(words) * (k % 6) * 0.012)):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        rows += [(2 * k, " ".join(words), "en", "s"), (2 * k + 1, " ".join(near), "en", "s")]
        pairs.append(jaccard(rows[-2][1], rows[-1][1]))
    got = simhash.fingerprints(docs(spark, rows + EDGE), None, 5).collect()
    want = sorted((i is None, i or 0, brute_wide(t)) for i, t, _, _ in rows + EDGE)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, sum((r[f"f{i}"] & (1 << 64) - 1) << 64 * i for i in range(4))) for r in got) == want
    kept = {r["doc_id"] for r in simhash.keep_one(docs(spark, rows), 5, 0.8).collect()}
    assert all(2 * k in kept for k in range(240))
    gone = {k: 2 * k + 1 not in kept for k in range(240)}
    share = lambda lo, hi: np.mean([gone[k] for k, j in enumerate(pairs) if lo <= j < hi])
    assert share(1.0, 1.1) == 1.0 and share(0.85, 1.0) > 0.85 and share(0.6, 0.7) < 0.1 and share(0.0, 0.6) == 0.0
    assert simhash.bits_apart(0.8) == 39 and simhash.bits_apart(1.0) == 0


def test_near_copies_are_those_of_all_pairs(spark, texts, monkeypatch):
    """Rows kept by similarity are those of an exact comparison of all pairs, whatever comes last in the order of shingles."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ala", "ero", "ini", "ost", "und")]
    common = [rng.choice(vocabulary) for _ in range(40)]
    rows = list(texts) + EDGE
    for k in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(6, 200))] + common * (k % 3 == 0)
        rows.append((500_000 + 3 * k, " ".join(words), "en", "s"))
        for c in (1, 2):  # a chain of changes near the threshold
            words = list(words)
            for _ in range(max(1, round(len(words) * rng.uniform(0.005, 0.035)))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((500_000 + 3 * k + c, " ".join(words), "en", "s"))

    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(t) for _, t, _, _ in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = []
    for i, k in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[k])
        if sets[i] == sets[k] or 5 * both >= 4 * (len(sets[i]) + len(sets[k]) - both):
            links.append((i, k))
            up[root(k)] = root(i)
    least = {}
    for i, (d, _, _, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), (True, 0)), (d is None, d or 0))
    assert len(links) > 200
    for often, most in ((simhash.FREQUENT, simhash.MOST), (1, 1_000)):
        monkeypatch.setattr(simhash, "FREQUENT", often)
        monkeypatch.setattr(simhash, "MOST", most)
        kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in simhash.keep_one(docs(spark, rows), 5, 0.8).collect())
        assert kept == sorted(least.values())


def test_few_sets_of_long_texts_are_moved(spark):
    """Long texts that share a passage and little else are told apart by their parities, which exclude no pair that is similar; only rows looked for are joined."""
    rng = random.Random(12)
    vocabulary = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ala", "ero", "ini", "ost", "und")]
    passage, rows = [rng.choice(vocabulary) for _ in range(40)], []
    for k in range(40):
        words = passage + [rng.choice(vocabulary) for _ in range(rng.randint(1_400, 1_700))]
        near = list(words)
        for _ in range(10 * (k % 4)):
            near[rng.randrange(len(near))] = rng.choice(vocabulary)
        rows += [(2 * k, " ".join(words), "en", "s"), (2 * k + 1, " ".join(near) + " end", "en", "s")]
    sets = {i: set(simhash.shingle_set(t.encode(), 5).tolist()) for i, t, _, _ in rows}
    parities = {i: simhash._parities(simhash.shingle_set(t.encode(), 5)) for i, t, _, _ in rows}
    parities |= {-n: simhash._parities(np.array(sorted(s)[:n], np.uint64)) for n, s in ((1, sets[0]), (700, sets[0]), (1_200, sets[2]))}
    sets |= {-n: set(sorted(s)[:n]) for n, s in ((1, sets[0]), (700, sets[0]), (1_200, sets[2]))}
    assert all(simhash._differing(parities[i], parities[k]) <= len(sets[i] ^ sets[k]) for i, k in itertools.combinations(sets, 2))
    d = docs(spark, rows)
    nodes = simhash._sketches(d, F.lit(0).cast("bigint"), 5, 0.8).withColumn("root", F.col("node")).localCheckpoint()
    ids = {r["node"]: r["doc_id"] for r in nodes.collect()}
    met = {tuple(sorted((ids[r["a"]], ids[r["b"]]))) for r in simhash._meetings(nodes, 0.8).collect()}
    similar = {(i, k) for i, k in itertools.combinations(range(80), 2) if len(sets[i] & sets[k]) >= 0.8 * len(sets[i] | sets[k])}
    assert len(similar) == 40 and similar <= met and len(met) <= 44
    used = spark.createDataFrame([(7,), (-9,), (1 << 40,)], "of bigint")
    kept = [r["row"] for r in simhash._marked(spark.range(-1_000, 1_000).union(spark.createDataFrame([(1 << 40,)], "id bigint")).toDF("row"), "row", used, "of").collect()]
    assert {7, -9, 1 << 40} <= set(kept) and len(kept) <= 5


def test_crowded_anchors_and_frequent_fingerprints(spark, monkeypatch):
    """20,000 fingerprints of one half, so at one anchor, compared in pairs of blocks; and fingerprints of many rows joined apart."""
    rng = np.random.default_rng(6)
    other = np.unique(rng.integers(0, 1 << 32, 20_000, dtype=np.uint64))
    near = other[:200] ^ np.uint64(1 << 7) ^ np.uint64(1 << 29)
    fps = np.unique(np.concatenate([other, near])) << np.uint64(32)
    df = spark.createDataFrame([(i, int(f)) for i, f in enumerate(fps.view(np.int64).tolist())] + [(i, 0) for i in range(50_000, 50_020)], "doc_id bigint, f0 bigint")
    results = []
    for block, sampled, hot in ((1 << 30, 1_024, 1 << 30), (1_500, 4, 5)):
        monkeypatch.setattr(simhash, "BLOCK", block)
        monkeypatch.setattr(simhash, "SAMPLED", sampled)
        monkeypatch.setattr(simhash, "HOT", hot)
        results.append(sorted((r["doc_id"], r["component_id"]) for r in simhash._labelled(df).collect()))
    assert results[0] == results[1]
    found = dict(results[1])
    places = {int(f): i for i, f in enumerate(fps)}
    assert all(found[places[int(a) << 32]] == found[places[int(b) << 32]] for a, b in zip(other[:200], near, strict=True)) and found[50_019] == min(50_000, found[50_000])


def test_one_document_of_each_group_stays(spark, texts):
    apart = [(None if i is None else i + 100_000, t, a, b) for i, t, a, b in EDGE]  # an id that is in several components keeps a row in each
    rows = texts + apart + [(i, t, "xx", "yy") for i, t, _, _ in texts[:5]]
    out = simhash.keep_one(docs(spark, rows))
    fp = [(i, brute_fingerprint(t)) for i, t, _, _ in rows]
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == sorted({c for c in brute_components(fp) if c is not None})
    assert out.columns == docs(spark, []).columns and out.count() == len({c for c in brute_components(fp)})
    assert simhash.keep_one(docs(spark, [])).count() == 0


# Tokens
@pytest.mark.parametrize("head", [0, 40, tokens.HEAD])
def test_token_counts_are_the_library_s(spark, texts, monkeypatch, head):
    """Whether the counts come from the join alone, from both, or from the frequent pre-tokens alone."""
    from tokenizers import Tokenizer

    monkeypatch.setattr(tokens, "HEAD", head)
    path = queries._vocabulary("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    more = ["it's we'll I'M 'S", "a b  c  d", "<|endoftext|>", " <|endoftext|><|endoftext|> x", "tab\t\tand\r\n\r\n end  ", "٣٤ ½ ²x", "é नमस्ते ไทย 🙂🙂", "\x85\x1c\x1d a", "ſK"]
    rows = texts + EDGE + [(100_000 + i, t, None, None) for i, t in enumerate(more)]
    want = sorted(((i, len((t or "").encode()), (n := len(lib.encode(t or "", add_special_tokens=False).ids)), n > 512) for i, t, _, _ in rows), key=repr)
    assert sorted(map(tuple, tokens.count_tokens(docs(spark, rows), path).collect()), key=repr) == want
    assert tokens.count_tokens(docs(spark, []), path).count() == 0


def test_frequent_rows(spark):
    from chronopix.llm.common import frequent

    df = spark.createDataFrame([(i, n) for i, n in enumerate([1, 1, 1, 1, 2, 2, 3, 9, 100, 0, None])], "i int, n bigint")
    got = lambda limit: sorted(r["n"] for r in frequent(df, "n", limit).collect())
    assert got(0) == [] and got(1) == [100] and got(4) == [3, 9, 100] and got(5) == got(8) == [2, 2, 3, 9, 100] and got(9) == [1, 1, 1, 1, 2, 2, 3, 9, 100]
    assert frequent(df.limit(0), "n", 5).count() == 0


# Mixing
def test_mix_with_edges_matches_plain_running_sums(spark, texts, con, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 20)  # so that there are several prefixes
    d = docs(spark, texts + EDGE)
    con.register("edge", d.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    got = mixing.mix(d)
    check(got.drop("source"), con, mixing.sql("edge"))
    rows = got.collect()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    total, target = sum(r["size"] for r in rows), {r["source"]: r["target"] for r in rows}
    assert sum(target.values()) == pytest.approx(1.5 * total)
    for s, t in target.items():
        assert abs(sum(r["taken"] for r in rows if r["source"] == s) - t) < 1
    at = [r["position"] for r in rows if r["position"] is not None]
    assert at == sorted(at) and all(0 <= p <= 1 for p in at)
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.mix(docs(spark, [(1, None, None, None)])).first()["taken"] == 0


def test_every_pass_has_its_position(spark, texts):
    """In every tenth of training each source gives what its schedule's integral says, within a document; written without the operator's formulas."""
    plan = mixing.curriculum(docs(spark, texts + EDGE))
    rows = plan.collect()
    assert all((r["positions"][:1] or [None])[0] == r["position"] for r in rows) and max(len(r["positions"]) for r in rows) > 1
    words = mixing.schedule(plan).collect()
    assert [w["position"] for w in words] == sorted(w["position"] for w in words) and all(w["words"] > 0 for w in words)
    names = sorted({r["source"] for r in rows}, key=lambda x: (x is None, x or ""))
    target, tilt = {r["source"]: r["target"] for r in rows}, {n: (0.5, 0.0, -0.5)[i % 3] for i, n in enumerate(names)}
    longest, total = {n: max(r["size"] for r in rows if r["source"] == n) for n in names}, sum(target.values())
    steps = 20_000  # t in small steps: weights at t, their integrals, and which t has given a share of all tokens
    integral, share_at = dict.fromkeys(names, 0.0), []
    per_tenth = {n: [] for n in names}
    for i in range(steps):
        for n in names:
            integral[n] += target[n] * (1 + tilt[n] * (1 - 2 * (i + 0.5) / steps)) / steps
        share_at.append(sum(integral.values()) / total)
        if share_at[-1] >= (len(per_tenth[names[0]]) + 1) / 10 - 1e-9:
            for n in names:
                per_tenth[n].append(integral[n])
    for n in names:
        assert sum(w["words"] for w in words if w["source"] == n) == sum(r["taken"] for r in rows if r["source"] == n)
        for tenth, want in enumerate(per_tenth[n], 1):
            got = sum(w["words"] for w in words if w["source"] == n and w["position"] < tenth / 10)
            assert abs(got - want) <= longest[n] + 2, (n, tenth)


def test_rows_equal_to_the_mix_share_a_group(spark, monkeypatch, con):
    monkeypatch.setattr(mixing, "GROUP", 20)
    monkeypatch.setattr(mixing, "COPIES", 7)  # so that copies come in several runs
    d = docs(spark, [(None, "a b", "en", "s")] * 50 + [(5, "x y z", "en", "s")] * 30 + [(i, "one two", "en", "t") for i in range(40)])
    con.register("copies", d.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    check(mixing.mix(d).drop("source"), con, mixing.sql("copies"))


# Lattice
def test_lattice_together_as_alone(monkeypatch):
    byte_names = [f"<0x{b:02X}>" for b in range(256)]
    pieces = {"▁": -2.0, "▁a": -3.0, "a": -2.5, "b": -2.0, "ab": -3.0, "ba": -3.5, "▁ab": -4.0, "aba": -5.0, "日本": -6.0}
    lat = lattice.Lattice([*pieces, *byte_names], [*pieces.values(), *[-6.0] * 256], byte_names)
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abé日本\U0001f600"), rng.integers(1, 9))) for _ in range(500)] + ["a" * 70, "é" * 65, "日" * 30]
    for few, cells in ((1, 400_000), (16, 40), (1, 40)):
        monkeypatch.setattr(lattice, "FEW", few)
        monkeypatch.setattr(lattice, "CELLS", cells)
        assert np.allclose(lat.forwards(words), [lat.forward(w) for w in words], rtol=1e-12)
        one: dict[int, float] = {}
        every = np.zeros(len(lat.names))
        for w in words:
            lat.expected(w, 0.5, one)
        lat.expectations(words, 0.5, every)
        assert np.allclose(every, [one.get(k, 0.0) for k in range(len(every))], rtol=1e-9, atol=1e-12)
    model, c = lattice.Scores(lat, -2.0, 1000.0, 0.6, 1000.0), np.arange(len(words)) % 3
    assert np.allclose(model.words(words, c), [model.word(w, int(k)) for w, k in zip(words, c, strict=True)], rtol=1e-12)
    assert len(lat.forwards([])) == 0


def test_forward_sums_all_segmentations():
    byte_names = [f"<0x{b:02X}>" for b in range(256)]
    pieces = {"▁": -3.0, "▁a": -1.0, "a": -1.5, "b": -2.0, "ab": -1.2, "ba": -2.2, "▁ab": -2.1}
    lat = lattice.Lattice([*pieces, *byte_names], [*pieces.values(), *[-6.0] * 256], byte_names)

    def brute(s):
        if not s:
            return 1.0
        one = sum(-6.0 for _ in s[0].encode())
        ways = [(1, pieces.get(s[0], one))] + [(n, pieces[s[:n]]) for n in range(2, len(s) + 1) if s[:n] in pieces]
        return sum(math.exp(p) * brute(s[n:]) for n, p in ways)

    for w in ("", "a", "ab", "abab", "xbé", "baab"):
        assert lat.forward(w) == pytest.approx(math.log(brute("▁" + w)))
        into = {}
        lat.expected(w, 1.0, into)
        assert sum(v * len(lat.names[k] if not lat.names[k].startswith("<0x") else "z" * 0) for k, v in into.items()) <= len(w) + 1 + 1e-9 and all(v > 0 for v in into.values())


def test_scores_base_and_joined_words(spark, texts, monkeypatch):
    rows = texts + EDGE
    path = queries._vocabulary("piece_bpe_32k.model")
    whole = {repr((r["doc_id"], r["n_tokens"], round(r["score"], 6))) for r in lattice.report(docs(spark, rows), path, ranked=True).collect()}
    monkeypatch.setattr(lattice, "HEAD", 50)  # so that most words are joined
    got = lattice.report(docs(spark, rows), path, ranked=True).collect()
    assert {repr((r["doc_id"], r["n_tokens"], round(r["score"], 6))) for r in got} == whole and len(got) == len(rows)
    from zlib import crc32

    held = lambda i: crc32(("" if i is None else str(i)).encode()) % 5 == 1
    toks = lambda t: [w.decode() for w in (t or "").encode().lower().split()] + ["\n"]
    c = Counter(w for i, t, _, _ in rows if not held(i) for w in toks(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(w := toks(t)), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 4)) for i, t, _, _ in rows), key=repr)
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got), key=repr) == want
    assert all(r["score"] < 0 for r in got)
    assert lattice.report(docs(spark, []), path, ranked=True).count() == 0


def test_scores_against_brute_force(spark):
    """A document's score from all segmentations of its words, with expected counts by plain enumeration; and that of the vocabulary alone."""
    path = queries._vocabulary("piece_bpe_32k.model")
    words = ["ab", "Ab", "cab", "abc", "zz", "é", "ab", "x1"]
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(words + [f"q{i}"]) for _ in range(rng.randint(0, 6))), None, None) for i in range(40)]
    got = {r["doc_id"]: r for r in lattice.report(docs(spark, rows), path, ranked=True).collect()}

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    start, single = {}, {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            n = sp.id_to_piece(i)
            if sp.is_byte(i):
                single[int(n[3:5], 16)] = n
            else:
                start[n] = 1 / (2 - sp.get_score(i))
    least = min(start.values()) / 16
    start |= {f"<0x{b:02X}>": least for b in range(256)}
    total = sum(start.values())
    start = {n: v / total for n, v in start.items()}

    def ways(s):
        """Every segmentation of the marked word, as lists of pieces; a character that is no piece is its bytes."""
        if not s:
            yield []
            return
        for n in range(1, len(s) + 1):
            piece = [s[:n]] if s[:n] in start and not s[:n].startswith("<0x") else [f"<0x{b:02X}>" for b in s[0].encode()] if n == 1 else None
            for rest in ways(s[n:]) if piece else ():
                yield piece + rest

    def chance(word, p):
        return sum(math.prod(p[x] for x in way) for way in ways("▁" + word))

    from zlib import crc32

    held = lambda i: crc32(str(i).encode()) % 5 == 1
    split = lambda t: t.translate({c: c + 32 for c in range(65, 91)}).split()
    train = [split(t) for i, t, _, _ in rows if not held(i)]
    c = Counter(w for t in train for w in t)
    n1, n2 = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    counts = dict.fromkeys(start, lattice.FLOOR)
    for w in c:
        whole = chance(w, start)
        for way in ways("▁" + w):
            for x in way:
                counts[x] += d * math.prod(start[y] for y in way) / whole
    end, spelled = len(train) + 0.5, d * len(c)
    z, pieces = sum(c.values()) - d * len(c) + spelled + end, sum(counts.values()) + spelled
    tuned = {n: v / pieces for n, v in counts.items()}
    for i, t, _, _ in rows:
        each = [spelled / z * spelled / pieces * chance(w, tuned) + max(c[w] - d, 0) / z for w in split(t)]
        assert got[i]["score"] == pytest.approx(sum(map(math.log10, each)) + math.log10(end / z), abs=1e-8)
        assert got[i]["vocabulary_score"] == pytest.approx(sum(math.log10(chance(w, start)) for w in split(t)), abs=1e-8)


# Classifiers
def _labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


@pytest.mark.parametrize("report,label", [(quality.report, "quality"), (toxicity.report, "toxic")])
def test_reruns_agree_to_the_bit(spark, report, label):
    """Whatever the order of rows and of an id's conflicting labels."""
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = _labels(spark, "/root/testdata/sf0.01").select("doc_id", label)
    labels = labels.union(labels.where("doc_id % 7 = 0").select("doc_id", 1 - labels[label]))
    d = d.union(d.where("doc_id % 5 = 3").withColumn("text", d["text"].substr(1, 300)))
    runs = [sorted(map(tuple, report(d.repartition(k).sortWithinPartitions(by), labels.repartition(k)).select("doc_id", "score").collect())) for k, by in ((3, "doc_id"), (7, "text"))]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("name,label", [("op6_nbsvm_quality", "quality"), ("op9_weak_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    sf = "/root/testdata/sf0.1"
    got = queries.queries()[name](spark, sf).join(_labels(spark, sf), "doc_id").where("held_out").select("predicted", label).collect()
    assert len(got) > 300 and sum(r[0] == r[1] for r in got) / len(got) > 0.97


@pytest.mark.parametrize("report", [quality.report, toxicity.report])
def test_classifier_edges(spark, report):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, None, None, "x"), (5, 0, 1, "x"), (6, 1, 0, "x"), (6, 0, 1, "x"), (None, 1, 1, "x")], "doc_id bigint, quality int, toxic int, text string")
    got = report(docs(spark), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert len(report(docs(spark), labels.limit(0)).collect()) == len(EDGE) and report(docs(spark, []), labels).count() == 0


def test_toxic_recall_by_language(spark):
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), _labels(spark, sf)
    got = queries.op9_weak_toxicity(spark, sf).where("held_out").join(labels.where("toxic = 1"), "doc_id").join(d.select("doc_id", "lang"), "doc_id").collect()
    for lang in ("en", "de", "fr", "es"):
        caught = [r["predicted"] for r in got if r["lang"] == lang]
        assert len(caught) > 10 and sum(caught) / len(caught) > 0.8, lang
    model = toxicity.train(d, labels, toxicity.held_out)
    assert model.hits("moron") and model.score("moron") > model.score("")


def test_voters_beyond_the_cover_and_repeats():
    assert toxicity.features("Abcde abcdx a") == {"abcde", "abcdx", "abcd*", "abcd*2", "a"}
    hits, y = [np.array([0, 1, 2, 3])] * 6 + [np.array([0, 1, 2, 3, 4])] * 2 + [np.array([1, 4])] * 2, np.array([1] * 8 + [0] * 2)
    assert toxicity.choose(list("abcde"), np.array([9.0, 5, 9, 9, 3]), hits, y, least=2) == ["a", "b", "e"]  # c and d fire where a does


def test_label_model_finds_rates_and_correlations_without_labels():
    """Simulated voters of known rates, one of them copied twice with little change, and one against."""
    rng = np.random.default_rng(3)
    n, prior = 40_000, 0.15
    y = rng.random(n) < prior
    on, off = np.array([0.6, 0.5, 0.4, 0.3, 0.7, 0.05]), np.array([0.02, 0.01, 0.03, 0.005, 0.1, 0.4])
    votes = rng.random((n, 6)) < np.where(y[:, None], on, off)
    copies = [np.where(rng.random(n) < 0.02, ~votes[:, 0], votes[:, 0]) for _ in range(2)]
    votes = np.column_stack([votes, *copies])
    sign = np.array([1, 1, 1, 1, 1, -1, 1, 1])
    rows, weight = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.LabelModel(rows.astype(float), weight.astype(float), sign, prior)
    assert np.allclose(model.on[:6], on, atol=0.08) and np.allclose(model.off[:6], off, atol=0.03)
    assert model.correlation[0, 6] > 0.6 and model.weights[[0, 6, 7]].max() < 0.5 < model.weights[[1, 2, 3, 4, 5]].min()
    found = toxicity._sigmoid(model.logit(votes.astype(float))) > 0.5
    assert (found == y).mean() > 0.95
    alone = toxicity.calibrated(model.logit(rows.astype(float)), np.array([(y & (votes == r).all(axis=1)).sum() for r in rows], float), np.array([(~y & (votes == r).all(axis=1)).sum() for r in rows], float))
    assert abs((alone * weight).sum() / n - prior) < 0.01


def test_linear_classifier_against_plain_descent():
    rng = np.random.default_rng(4)
    votes, weight, sign = (rng.random((30, 4)) < 0.4).astype(float), rng.integers(1, 9, 30).astype(float), np.array([1, 1, 1, -1])
    target = rng.random(30)
    w, b = toxicity.linear(votes, sign, weight, target, penalty=0.7)
    x = np.array([[*v, *(float(min(3, v[:3].sum()) == k) for k in range(4)), 1.0] for v in votes])
    z, ridge = np.zeros(9), np.array([0.7] * 8 + [1e-6])
    for _ in range(60_000):
        z -= 0.01 * (x.T @ (weight * (1 / (1 + np.exp(-x @ z)) - target)) + ridge * z)
    assert np.allclose([*w, b], z, atol=1e-3)


def test_toxicity_scores_against_brute_force(spark):
    """The classifier's score of every document, from its voters' patterns by plain search."""
    sf = "/root/testdata/sf0.01"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), _labels(spark, sf)
    model = toxicity.train(d, labels, toxicity.held_out)
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.score(d, model).collect()}
    import re

    for r in d.collect():
        words, fires = re.findall(r"[^\W\d_]+", r["text"].lower()), []
        for v, i in model.known.items():
            stem, times = v.rstrip("0123456789"), int(v[len(v.rstrip("0123456789")) :] or 1)
            met = sum(w.startswith(stem[:-1]) and len(w) > len(stem) - 1 if stem.endswith("*") else w == stem for w in words)
            fires += [i] if met >= times else []
        x = model.bias + sum(model.weights[i] for i in fires) + model.weights[len(model.known) + min(3, sum(i < model.speaking for i in fires))]
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-x)), abs=1e-9)


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    rows = [np.unique(np.concatenate([rng.integers(100, 5000, 20), [1 if v else 2]])).astype(np.int32) for v in y]
    m = quality.fit(rows, y)
    assert all((m.score(r) >= 0.5) == bool(v) for r, v in zip(rows, y, strict=True))


def test_dual_coordinate_descent_against_the_primal():
    """The scaled indicators by their definition, and the objective at the answer against subgradient descent's best."""
    rng = np.random.default_rng(2)
    y = (rng.random(120) < 0.35).astype(int)
    rows = [np.unique(np.concatenate([rng.integers(0, 40, 8), [50 if v and rng.random() < 0.7 else 51]])).astype(np.int32) for v in y]
    model = quality.fit(rows, y)
    size = 60
    has = np.zeros((120, size))
    for i, r in enumerate(rows):
        has[i, r] = 1
    pos, neg = has[y == 1].sum(axis=0) + 1, has[y == 0].sum(axis=0) + 1
    ratio = np.where(pos + neg < 4, 0, np.log(pos / ((y == 1).sum() + 2)) - np.log(neg / ((y == 0).sum() + 2)))
    x = np.column_stack([has * ratio / np.sqrt(has.sum(axis=1, keepdims=True)), np.ones(120)])
    side, cost = np.where(y > 0, 1.0, -1.0), np.where(y > 0, 120 / (2 * (y == 1).sum()), 120 / (2 * (y == 0).sum()))
    objective = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - side * (x @ w))).sum()
    scaled = np.divide(model.weights[:size].astype(float), ratio, out=np.zeros(size), where=ratio != 0)
    best, w = np.inf, np.zeros(size + 1)
    for k in range(1, 40_000):
        active = side * (x @ w) < 1
        w -= (w - x.T @ (cost * side * active)) / (k + 50)
        best = min(best, objective(w))
    assert objective(np.append(scaled, model.bias)) <= best * 1.02 + 0.05
    for r in rows[:10]:
        margin = model.weights[r].sum() / math.sqrt(len(r)) + model.bias
        assert model.score(r) == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.shift))), abs=1e-6)


def test_languages_against_plain_out_of_place_distances(spark, texts):
    import re
    from zlib import crc32

    def grams(t):
        n = Counter()
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            if all(map(str.isalpha, w)):
                m = f"_{w}_"
                n.update(m[i : i + k] for k in (1, 2, 3) for i in range(len(m) - k + 1) if m[i : i + k] != "_")
        return n

    rows = texts[:150] + [(900_000 + i, t, None, None) for i, t in enumerate(["", None, "123 ...", "the", "le la les", "una niña", "ein Häuschen"])]
    counts: dict[str, Counter] = {}
    for i, t, lang, _ in rows:
        if lang and crc32(str(i).encode()) % 4 != 2:
            counts.setdefault(lang, Counter()).update(grams(t))
    profiles = {n: {g: k for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:1_000])} for n, c in counts.items()}
    far = max([300, *map(len, profiles.values())])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.report(docs(spark, rows)).collect()}
    for i, t, _, _ in rows:
        own = [g for g, _ in sorted(grams(t).items(), key=lambda x: (-x[1], crc32(x[0].encode())))[:300]]
        if not own:
            assert got[i] == ("und", 0.0)
            continue
        out = {n: sum(abs(p[g] - k) if g in p else far for k, g in enumerate(own)) for n, p in profiles.items()}
        least = min(out.values())
        assert got[i][0] == min(n for n in out if out[n] == least) and got[i][1] == pytest.approx(1 - least / (far * len(own)), abs=1e-9)


def test_language_accuracy_and_edges(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op10_rank_order_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97
    rows = langid.report(docs(spark)).collect()
    assert len(rows) == len(EDGE) and {r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 9)} == {"und"} and all(0 <= r["score"] <= 1 for r in rows)
    assert langid.report(docs(spark, [(1, "abc", None, None)])).first()["lang_pred"] == "und" and langid.report(docs(spark, [])).count() == 0


def test_numbered_ngrams_are_the_ngrams(texts):
    n = langid.Numbers()
    many = "".join(map(chr, range(0x4E00, 0x4E00 + 200)))
    for t in [t for _, t, _, _ in texts[:60]] + ["", "a", "Ab  cd-e", "x²y _z", "привет мир", many, "ab cd"]:
        names = n(t)
        known = list(n.ids)
        assert Counter(known[i] for i in names) == Counter(langid.grams(t))


# Licences
def test_licence_variants(spark):
    mit = licenses.KNOWN["MIT-text"]
    rows = [(1, mit, None, None), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,"), None, None), (3, mit.replace("license", "licence") + " extra", None, None), (4, "Licenced under CC BY-NC 4.0", None, None), (5, None, None, None), (6, "Copyright 1999 x", None, None)]
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs(spark, rows)).collect()}
    assert got == {1: "MIT-text", 2: "MIT-text", 3: None, 4: "notice-CC-BY-NC-4.0", 5: None, 6: None}
    assert licenses.scan(docs(spark)).count() == len(EDGE) and licenses.scan(docs(spark, [])).count() == 0


def test_found_licences_are_the_sql_s(spark, con):
    """Rows whose licence is not null, for both: every known text as it is, some with a changed case and other spellings, some with a word more."""
    rows = [(i, t, None, None) for i, t in enumerate(licenses.KNOWN.values())]
    rows += [(1_000 + i, t.upper().replace("LICENSE", "LICENCE"), None, None) for i, t, _, _ in rows] + [(2_000 + i, t + " word", None, None) for i, t, _, _ in rows] + EDGE
    d = docs(spark, rows)
    con.register("licensed", d.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    found = licenses.scan(d)
    want = {r[0]: r[2] for r in con.sql(licenses.sql("licensed")).fetchall() if r[0] is not None and r[2]}
    got = {r["doc_id"]: r["license_id"] for r in found.collect() if r["license_id"]}
    assert len(want) > 40 and all(got[i] == n for i, n in want.items()) and all(n in licenses.KNOWN for n in got.values()) and not [i for i in got if 2_000 <= i < 3_000]


def test_wrapped_copies_of_every_known_text(spark):
    import textwrap

    def wrapped(text, width):
        blocks = [[]]
        for line in text.split("\n"):
            alone = not line.strip() or licenses._STATEMENT.match(line.encode())
            blocks += [[line], []] if alone else []
            blocks[-1].extend([] if alone else [line])
        return "Copyright (c) 2020 Someone\nAll rights reserved.\n" + "\n".join(b[0] if b and licenses._STATEMENT.match(b[0].encode()) else textwrap.fill(" ".join(b), width, break_long_words=False, break_on_hyphens=False) for b in blocks)

    least = {}
    for n, t in sorted(licenses.KNOWN.items(), reverse=True):
        least[licenses.canonical(t.encode(), licenses._STATEMENT)] = n
    want = [least[licenses.canonical(t.encode(), licenses._STATEMENT)] for t in licenses.KNOWN.values()]
    assert {"Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "Unlicense", "CC0-1.0"} <= set(want)
    rows, names = [], []
    for width in (40, 60, 72, 80, 100):
        for t, n in zip(licenses.KNOWN.values(), want, strict=True):
            rows.append((len(rows), wrapped(t, width), None, None))
            names.append(n)
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs(spark, rows)).collect()}
    assert [got[i] for i in range(len(rows))] == names
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"
    assert licenses.scan(docs(spark, [(1, isc + licenses.KNOWN["ISC-text"].split("\n", 1)[1], None, None)])).first()["license_id"] == "ISC-text"


# Decontamination
def brute_hits(words, items, window):
    hit, found = set(), set()
    for i, it in items:
        w = min(window, len(it))
        for a in range(len(it) - w + 1) if it else ():
            for b in range(len(words) - w + 1):
                if words[b : b + w] == it[a : a + w]:
                    hit |= set(range(b, b + w))
                    found.add(i)
    return hit, found


def test_automaton_against_all_windows():
    rng = random.Random(5)
    for _ in range(300):
        window = rng.randint(1, 5)
        word = lambda: bytes([97 + rng.randrange(3)])
        items = [(i, [word() for _ in range(rng.randint(0, 9))]) for i in range(rng.randint(0, 5))]
        text = [word() if rng.random() < 0.9 else b"z" for _ in range(rng.randint(0, 40))]
        spans, found = decontaminate.Automaton(items, window).match(text)
        hit, want = brute_hits(text, items, window)
        assert {p for a, b in spans for p in range(a, b)} == hit and found == want


def test_decontamination_edges_blocks_and_cuts(spark, monkeypatch):
    passage = " ".join(f"q{i}" for i in range(15))
    rows = [(1, f"Start, {passage.upper()}! end", "en", "s"), (2, "short item HERE and more words " * 30, "en", "s"), (3, None, None, None), (4, "nothing", "en", "s"), (5, passage + " " + " ".join(["pad"] * 400), "en", "s")]
    items = spark.createDataFrame([(10, passage, 1), (2, "Short ITEM here", 1), (3, None, 1), (4, "...", 1), (None, "nothing", 1)], "item_id bigint, text string, spans int")
    want = None
    for bound in (10**6, 3):  # one automaton, then several
        monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", bound)
        got = sorted((r["doc_id"], r["n_hit"], r["n_items"], r["contaminated"], r["items_sha256"]) for r in decontaminate.report(docs(spark, rows), items).collect())
        assert want is None or got == want
        want = got
    assert [g[:4] for g in want] == [(1, 15, 1, True), (2, 90, 1, True), (3, 0, 0, False), (4, 1, 0, True), (5, 15, 1, False)]
    kept = {r["doc_id"]: r for r in decontaminate.remove(docs(spark, rows), items, longest=13, drop=False).collect()}
    assert kept[1]["text"] == "Start, ! end" and kept[1]["n_chars"] == 12 and kept[5]["text"].startswith(" pad") and kept[3]["text"] is None
    assert sorted(r["doc_id"] for r in decontaminate.remove(docs(spark, rows), items).collect()) == [3, 5]
    assert decontaminate.report(docs(spark, []), items).count() == 0 and decontaminate.report(docs(spark), items.limit(0)).count() == len(EDGE)


# Pipeline
def test_stages(spark, sf, tmp_path):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    columns = d.columns
    tokens_of = lambda t: __import__("re").findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    items = [tokens_of(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + min(13, len(w))]) for w in items for i in range(len(w) - min(13, len(w)) + 1) if w}

    def clean(text):
        w, hit = tokens_of(text), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        return not hit or 20 * len(hit) < len(w)

    judged = {
        "language": lambda x: {r["doc_id"] for r in x.collect() if any(map(str.isalpha, r["text"] or ""))},
        "toxicity": lambda x: {r["doc_id"] for r in toxicity.score(x, toxicity.train(x, _labels(spark, sf), toxicity.held_out)).collect() if r["toxicity"] < toxicity.THRESHOLD},
        "decontamination": lambda x: {r["doc_id"] for r in x.collect() if clean(r["text"])},
    }
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, d, sf)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name in judged:
            assert out.columns == columns and {r["doc_id"] for r in out.select("doc_id").collect()} == judged[name](d)
        if name == "near_dedup":  # none that plain comparison of all pairs keeps may go; nearly all that it joins is joined
            before, kept = [(r["doc_id"], r["text"]) for r in d.collect()], {r["doc_id"] for r in out.collect()}
            wide = [brute_wide(t) for _, t in before]
            up = list(range(len(before)))
            for i, k in itertools.combinations(range(len(before)), 2):
                if (wide[i] ^ wide[k]).bit_count() <= 39:
                    a, b = (next(x for x in iter(lambda c=[j]: c.__setitem__(0, up[c[0]]) or c[0], None) if up[x] == x) for j in (i, k))
                    up[max(a, b)] = min(a, b)
            roots = {before[i][0] for i in range(len(before)) if up[i] == i}
            assert roots <= kept and len({t for i, t in before if i in kept}) == len(kept) <= len(roots) + 3
        d = out
    assert sorted(map(repr, d.collect())) == sorted(map(repr, corpus_pipeline.run(spark, sf).collect()))


def test_language_stage_rejects_other_languages(spark, sf, texts):
    foreign = [
        "Witaj w naszym domu, dzisiaj jest bardzo ładna pogoda i idziemy na spacer do parku z psem oraz kotem, a potem wrócimy na obiad",
        "Tervetuloa kotiimme, tänään on kaunis sää ja menemme kävelylle puistoon koiran kanssa, sitten syömme yhdessä päivällistä",
        "Привет, как дела, сегодня хорошая погода и мы идём гулять в парк с собакой, а потом вернёмся домой обедать вместе",
    ]
    rows = texts + [(900_000 + i, t, None, "s") for i, t in enumerate(foreign)]
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs(spark, rows), sf).select("doc_id").collect()}
    assert not kept & {900_000, 900_001, 900_002} and kept == {i for i, t, _, _ in texts if any(map(str.isalpha, t or ""))}


def test_language_stage_keeps_texts_with_letters(spark, sf):
    lettered = sorted((i for i, t, _, _ in EDGE if any(map(str.isalpha, t or ""))), key=repr)
    for rows in (EDGE, [(i, t, None, s) for i, t, _, s in EDGE]):  # languages to learn, and none
        out = corpus_pipeline.language(spark, docs(spark, rows), sf)
        assert sorted((r["doc_id"] for r in out.select("doc_id").collect()), key=repr) == lettered


def test_pipeline_on_edges(spark, sf):
    d = docs(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, d, sf).count() <= len(EDGE) and stage(spark, d.limit(0), sf).count() == 0
