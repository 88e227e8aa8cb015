"""Operators over the whole corpus: joins, models, graphs and the pipeline."""

import random

import numpy as np
from pyspark.sql import functions as F
from llm_fixtures import documents, edge_documents, edited, prose, save, with_clashes

from skulink.llm import masked_lm, ngramjoin, toxicity, urlgraph

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- op4

def brute_classes(rows, size=3, percent=90):
    sets = [frozenset(ngramjoin.shingles(t.encode() if t else None, size).tolist()) for _, t in rows]
    home = list(range(len(rows)))

    def top(i):
        while home[i] != i:
            i = home[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                home[top(i)] = top(j)
    ids: dict[int, list] = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(top(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    return sorted(((d, len(sets[i]), least[top(i)]) for i, (d, _) in enumerate(rows)), key=str)


def families(seed=4):
    """Families of copies with ever more edits, near-misses included."""
    r = random.Random(seed)
    rows = []
    for n in (9, 10, 20, 40, 120, 300):
        base = prose(r, n)
        rows += [edited(r, base, k) for k in (0, 0, 1, 1, 2, 2, 3, 4, 6, 8)]
    chain = prose(r, 150)
    for _ in range(30):                       # each a little further from the first
        chain = edited(r, chain, 1)
        rows.append(chain)
    passage = prose(r, 30)
    rows += [passage + " " + prose(r, r.randint(5, 60)) for _ in range(60)]
    return [(1000 - i, t) for i, t in enumerate(rows)]


def test_signatures_are_complete():
    r = random.Random(9)
    for _ in range(300):
        n = r.choice((9, 12, 30, 100, 400))
        a = np.unique(np.array([r.getrandbits(64) for _ in range(n)], np.uint64))
        k = max(0, len(a) // 19)
        b = np.unique(np.concatenate([a[k:], np.array([r.getrandbits(64) for _ in range(k)], np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            assert np.intersect1d(ngramjoin.signatures(a), ngramjoin.signatures(b)).size


def test_ngram_join_equals_brute_force(spark, monkeypatch):
    rows = families()
    docs = documents(spark, rows)
    for chunk in (ngramjoin.CHUNK, 500):       # small chunks: families spread over tasks
        monkeypatch.setattr(ngramjoin, "CHUNK", chunk)
        got = sorted((tuple(r) for r in ngramjoin.joined(docs).collect()), key=str)
        assert got == brute_classes(rows)


def test_ngram_join_edges_and_stage(spark):
    docs = with_clashes(edge_documents(spark))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sorted((tuple(r) for r in ngramjoin.joined(docs).collect()), key=str)
    assert got == brute_classes(rows)
    kept = ngramjoin.stage(spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("text = 'one'").collect()) == [3]
    assert kept.where("lower(text) = 'three little words'").count() == 1
    assert kept.count() == len(rows) - 4
    assert ngramjoin.joined(docs.limit(0)).count() == 0


def test_ngram_query(spark, sf_rows):
    got = sorted((tuple(r) for r in ngramjoin.op4_ngram_join(spark, SF).collect()), key=str)
    assert got == brute_classes(sf_rows)


def test_stage_drops_copies_between_the_thresholds(spark):
    words = [f"w{i}" for i in range(300)]
    subst = list(words)
    for i in range(25, 300, 50):               # 6 apart: 266 / 326 on five words, 280 / 316 on three
        subst[i] = f"x{i}"
    longer = words + [f"y{i}" for i in range(45)]
    other = list(words)
    for i in range(5, 300, 30):                # 10 apart: below 0.8 on five words
        other[i] = f"z{i}"
    rows = [(i, " ".join(w)) for i, w in enumerate((words, subst, longer, other))] + families()
    docs = documents(spark, rows)
    plain = {r["doc_id"]: r["component_id"] for r in ngramjoin.joined(docs.where("doc_id < 4")).collect()}
    assert plain == {0: 0, 1: 1, 2: 2, 3: 3}   # op4's own parameters
    got = sorted(r["doc_id"] for r in ngramjoin.stage(spark, docs, SF).collect())
    assert got == sorted({c for _, _, c in brute_classes(rows, 5, 80)}) and {0, 3} <= set(got)
    assert not {1, 2} & set(got)


def test_row_numbers_survive_other_file_splits(spark, tmp_path, monkeypatch):
    r = random.Random(21)
    rows = [(i, prose(r, 60)) for i in range(60)]
    rows += [(100 + i, edited(r, rows[i][1], 1)) for i in range(0, 60, 2)]
    documents(spark, rows).repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    splits = "spark.sql.files.minPartitionNum"
    signed = ngramjoin.signed

    def other_splits(*args):
        spark.conf.set(splits, "64")           # as if executors had joined between two jobs
        return signed(*args)

    monkeypatch.setattr(ngramjoin, "signed", other_splits)
    try:
        spark.conf.set(splits, "1")
        one = docs.rdd.getNumPartitions()
        got = sorted((tuple(x) for x in ngramjoin.joined(docs).collect()), key=str)
        assert got == brute_classes(rows)
        spark.conf.set(splits, "1")
        kept = sorted(x["doc_id"] for x in ngramjoin.stage(spark, docs, SF).collect())
        assert kept == sorted({c for _, _, c in brute_classes(rows, 5, 80)})
        assert spark.read.parquet(f"{tmp_path}/documents.parquet").rdd.getNumPartitions() > one
    finally:
        spark.conf.unset(splits)


def test_components_of_a_long_path(spark):
    from pyspark.sql import functions as F
    path = spark.range(40).select(F.format_string("%04d", F.col("id") + 1).cast("binary").alias("u"),
                                  F.format_string("%04d", F.col("id")).cast("binary").alias("v"))
    assert {bytes(r["v"]) for r in ngramjoin.components(path).collect()} == {b"0000"}


# ---------------------------------------------------------------- op6

def toxic_docs(seed, n):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = r.random() < 0.3
        w = prose(r, r.randint(30, 80)).split(" ")
        if toxic:
            for _ in range(4):
                w[r.randrange(len(w))] = r.choice(("grumbul", "snirk", "snirkling"))
        rows.append((i, " ".join(w)))
        labels.append((i, int(r.random() < 0.8), int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_docs(1, 700)
    docs = documents(spark, rows)
    known = spark.createDataFrame(labels[:500], "doc_id long, quality int, toxic int")
    out, threshold = toxicity.scored(docs, known, "p", sample=400, features=200)
    p = {r["doc_id"]: r["p"]["toxic"] for r in out.collect()}
    held = labels[500:]
    right = sum((p[i] >= threshold) == bool(t) for i, _, t in held)
    assert right >= 0.95 * len(held)


def test_toxicity_edges(spark, tmp_path):
    edge = with_clashes(edge_documents(spark))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    save(empty, tmp_path, "labels")
    kept = toxicity.stage(spark, edge, str(tmp_path))
    assert kept.columns == edge.columns and kept.count() == edge.count()   # nothing is known
    one_class = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (100, 1, None)],
                                      "doc_id long, quality int, toxic int")
    save(one_class, tmp_path, "labels")
    assert toxicity.stage(spark, edge, str(tmp_path)).count() == edge.count()
    assert toxicity.stage(spark, edge.limit(0), str(tmp_path)).count() == 0


# ---------------------------------------------------------------- op2

def test_masked_lm_gradient_and_normalisation():
    m = masked_lm.start(np.arange(masked_lm.PAD, dtype=float))
    rng = np.random.default_rng(0)
    seq = masked_lm.padded_ids(rng.integers(0, masked_lm.PAD, 60))
    ctx = masked_lm.context(seq, np.array([7]))
    every = np.arange(masked_lm.PAD)
    lp = masked_lm.log_probability(m, np.repeat(ctx, len(every), 1), every)
    assert abs(np.exp(lp).sum() - 1) < 1e-4
    at = np.arange(masked_lm.WINDOW, 60)
    before = masked_lm.log_probability(m, masked_lm.context(seq, at), seq[at]).sum()
    for _ in range(20):
        masked_lm.train_step(m, masked_lm.context(seq, at), seq[at], 0.1)
    assert masked_lm.log_probability(m, masked_lm.context(seq, at), seq[at]).sum() > before + 10
    again = masked_lm.unpacked(masked_lm.packed(m))
    assert all(np.array_equal(m[k], again[k]) for k in masked_lm.NAMES)


def test_masked_lm_learns_context(spark):
    r = random.Random(3)
    pairs = [("red", "apple"), ("blue", "sky"), ("green", "tree"), ("old", "house")]
    text = lambda n: " ".join(x for _ in range(n) for x in ("the", *r.choice(pairs)))
    rows = [(i, text(60)) for i in range(300)]
    broken = text(60).split(" ")
    r.shuffle(broken)
    docs = with_clashes(documents(spark, rows + [(900, text(60)), (901, " ".join(broken)),
                                                 (902, None), (903, ""), (904, text(20_000))]))
    got = {x["doc_id"]: x["lm"] for x in masked_lm.scored(docs).collect()}
    assert got[900]["score"] > got[901]["score"] + 20      # same words, other order
    assert got[902]["n_tokens"] == got[903]["n_tokens"] == 0 and got[902]["score"] == 0
    assert got[904]["n_tokens"] == 60_000
    assert masked_lm.scored(docs.limit(0)).count() == 0


def test_masked_lm_trains_on_every_position(spark):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, masked_lm.PAD, n) for n in (1, 0, 2, 7, 7, 3 * masked_lm.BLOCK + 5, 40)]
    got = list(masked_lm.blocks(texts))
    seqs = [masked_lm.padded_ids(t) for t in texts]
    at = [np.arange(len(t)) + masked_lm.WINDOW for t in texts]
    assert np.array_equal(np.concatenate([t for _, t in got]), np.concatenate(texts))
    assert np.array_equal(np.concatenate([c for c, _ in got], axis=1), np.concatenate(
        [masked_lm.context(s, a) for s, a in zip(seqs, at)], axis=1))
    assert max(len(t) for _, t in got) < 2 * masked_lm.BLOCK and masked_lm.ROUNDS >= 2
    # texts of two words only: their second word follows from the first
    pairs = ["red apple", "blue sky", "green tree", "old house"]
    docs = documents(spark, [(i, pairs[i % 4]) for i in range(4000)])
    odd = documents(spark, [(0, "red apple"), (1, "red sky")])
    got = {x["doc_id"]: x["lm"]["score"] for x in masked_lm.scored(
        odd, model=masked_lm.MaskedLm(docs)).collect()}
    assert got[0] > got[1] + 1


# ---------------------------------------------------------------- op7

def test_url_parts_and_rules(spark):
    rows = [(1, "http://A.Example.NET/en/x?q#f", ("a.example.net", "/en/x", "example.net/en/", "allow")),
            (2, "https://example.net/de/", ("example.net", "/de/", "net/", "block")),
            (3, "http://example.com/de/1", ("example.com", "/de/1", "example.com/de/", "block")),
            (4, "http://x.org/fr/1", ("x.org", "/fr/1", "org/fr/", "allow")),
            (5, "http://notexample.com/de/1", ("notexample.com", "/de/1", None, "allow")),
            (6, "no scheme", ("", "", None, "allow")), (7, None, ("", "", None, "allow")),
            (8, "http://shop.net?x=1/2", ("shop.net", "", None, "block")),
            (9, "http://a.net/x://b.org/fr/", ("a.net", "/x://b.org/fr/", "net/", "block")),
            (10, "", ("", "", None, "allow")), (10, "", ("", "", None, "allow"))]
    pages = spark.createDataFrame(
        [(i, u, '<a href="http://shop.net/x">s</a>' if i == 9 else None) for i, u, _ in rows],
        "page_id long, url string, html string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in urlgraph.judged(pages).collect()}
    assert got == {i: w[:3] for i, _, w in rows}
    assert urlgraph.judged(pages.limit(0)).count() == 0


def test_ranks_equal_a_dense_iteration(spark):
    r = random.Random(6)
    hosts = [f"h{i}.example.org" for i in range(12)]
    edges = {(r.choice(hosts), r.choice(hosts)): float(r.randint(1, 5)) for _ in range(40)}
    edges = {k: w for k, w in edges.items() if k[0] != k[1]}
    good, bad = {hosts[0]: 0.7, hosts[1]: 0.3}, {hosts[5]: 1.0}
    got = urlgraph.propagated(
        spark.createDataFrame([(*k, w) for k, w in edges.items()], "src string, dst string, w double"),
        spark.createDataFrame([(h, good.get(h, 0.0), bad.get(h, 0.0)) for h in hosts],
                              "host string, good double, bad double"), rounds=6)
    got = {x["host"]: (x["trust"], x["distrust"]) for x in got.collect()}
    at = {h: i for i, h in enumerate(hosts)}
    w = np.zeros((12, 12))
    for (a, b), x in edges.items():
        w[at[a], at[b]] = x
    for k, (m, seed) in enumerate(((w, good), (w.T, bad))):
        p = m / np.maximum(m.sum(1, keepdims=True), 1e-300)
        s = np.array([seed.get(h, 0.0) for h in hosts])
        rank = np.zeros(12)
        for _ in range(6):
            rank = 0.15 * s + 0.85 * p.T @ rank
        assert np.allclose([got[h][k] for h in hosts], rank)


def test_ranks_settle_on_a_long_chain(spark):
    r = random.Random(13)
    hosts = [f"h{i:02d}.org" for i in range(24)]
    # h00 -> h01 -> ... -> h17 (the only blocked seed), a dense part behind it
    edges = {(hosts[i], hosts[i + 1]): 1.0 for i in range(17)}
    edges |= {(a, b): float(r.randint(1, 5)) for a in hosts[17:] for b in hosts[17:] if a != b}
    seeds = [(h, float(h == hosts[20]), float(h == hosts[17])) for h in hosts]
    got = urlgraph.propagated(
        spark.createDataFrame([(*k, w) for k, w in edges.items()], "src string, dst string, w double"),
        spark.createDataFrame(seeds, "host string, good double, bad double"))
    got = {x["host"]: (x["trust"], x["distrust"]) for x in got.collect()}
    w = np.zeros((24, 24))
    for (a, b), x in edges.items():
        w[hosts.index(a), hosts.index(b)] = x
    dense = []
    for k, m in enumerate((w, w.T)):
        p = m / np.maximum(m.sum(1, keepdims=True), 1e-300)
        want = np.linalg.solve(np.eye(24) - 0.85 * p.T, 0.15 * np.array([x[k + 1] for x in seeds]))
        dense.append(want)
        # walks are summed from the seeds on: never more than the whole, never less than what verdicts need
        assert all(got[h][k] <= want[i] + 1e-12 for i, h in enumerate(hosts))
    for i, h in enumerate(hosts):
        assert (got[h][1] > 2 * got[h][0]) == (dense[1][i] > 2 * dense[0][i]), h
    assert got[hosts[0]][1] > 0 == got[hosts[0]][0]
    # pages: a host far up the chain is blocked
    page = lambda i: f'<a href="http://{hosts[i + 1]}/">x</a>' if i < 17 else None
    pages = spark.createDataFrame([(i, f"http://{hosts[i]}/", page(i)) for i in range(18)],
                                  "page_id long, url string, html string")
    out = urlgraph.judged(pages, rules=(("block", hosts[17], "/"),)).collect()
    assert {x["verdict"] for x in out} == {"block"} and len(out) == 18


def test_url_hot_host_long_html_and_clashing_columns(spark):
    long = "<p>x</p>" * 40_000 + '<a href="//bad.net/">b</a>'
    rows = [(i, "https://hub.org/a", '<a href="http://ok.org/fr/">x</a>') for i in range(300)]
    rows += [(400, "http://far.org/x", long), (401, "http://BAD.net/", None), (402, "http://ok.org/fr/1", ""),
             (403, None, "x"), (403, None, "x"), (404, "no scheme", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = ["host", "path", "r", "rank", "kind", "src", "dst", "trust", "seed", "id"]
    clash = pages.select("*", *[F.lit("extra").alias(n) for n in names])
    got = sorted(str(tuple(r)[:5]) for r in urlgraph.judged(clash).collect())
    assert got == sorted(str(tuple(r)[:5]) for r in urlgraph.judged(pages).collect()) and len(got) == len(rows)
    verdict = {r["page_id"]: r["verdict"] for r in urlgraph.judged(pages).collect()}
    assert verdict[0] == "allow" and verdict[400] == "block" and verdict[401] == "block"
    assert verdict[403] == verdict[404] == "allow"


# ---------------------------------------------------------------- pipeline

def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    for name, _ in corpus_pipeline.STAGES:
        assert isinstance(name, str)
    r = random.Random(12)
    rows, labels = toxic_docs(2, 300)
    bench = prose(r, 30)
    copy = dict(rows)[next(i for i, _, t in labels if not t)]
    rows += [(1000, copy), (1001, bench + " " + prose(r, 40)), (1002, "mail me: a@b.org " + prose(r, 60)),
             (1003, None), (1004, "")]
    save(documents(spark, rows), tmp_path, "documents")
    save(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    save(spark.createDataFrame([(1, bench)], "item_id long, text string"), tmp_path, "benchmark")
    out = {x["doc_id"] for x in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not out & {1000, 1001} and {1002, 1003, 1004} <= out
    toxic = {i for i, _, t in labels if t}
    assert len(out & toxic) <= 0.1 * len(toxic)
    clean = {i for i, _, t in labels if not t}
    assert len(out & clean) >= 0.97 * len(clean)


def test_texts_pass_a_filter_before_they_are_moved(spark):
    docs = spark.range(2000).selectExpr("id + shiftleft(id % 3, 33) uid", "string(id) raw")
    wanted = docs.where("raw % 50 = 0").select("uid")
    for bits in (64, 1 << 15, ngramjoin.FILTER_BITS):
        got = ngramjoin.sifted(docs, wanted, bits)
        assert got.columns == docs.columns
        assert got.join(wanted, "uid").count() == 40 and got.distinct().count() == got.count()
    assert got.count() < 60                     # few others stay
    assert ngramjoin.sifted(docs, wanted.limit(0)).count() == 0
    profiles = docs.selectExpr("uid", "uid node", "unhex(hex(raw)) key")
    sets = ngramjoin.shingle_sets(docs.selectExpr("uid", "cast(raw as binary) raw"), 3, profiles,
                                  wanted.withColumnRenamed("uid", "node"))
    assert sets.count() == 40
