"""Operators that read one document at a time: brute force and edge cases."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import pytest
from llm_fixtures import documents, edge_documents, edge_texts, prose, with_clashes

from skulink.llm import bpe, decontam, pii, quality, shard, tokcount

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- op1

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "ip" and any(int(x) > 255 for x in m[0].split("."))
                    or kind == "card" and not (14 <= len(d) <= 19 and pii.luhn(d))
                    or kind == "phone" and not 10 <= len(d) <= 15):
                continue
            out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(PATTERNS).index(s[0])))


def test_base_spans_equal_the_patterns():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choice("ab1290@@..--+ ()%_\u00e9") for _ in range(r.randint(1, 40)))
        assert pii.base_spans(t) == brute_spans(t)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.base_spans("x" + "0" * 6000 + "1.1.1.1")[0][0] == "ip"


def test_pii_query(spark, sf_rows):
    got = {r["doc_id"]: r for r in pii.op1_pii(spark, SF).collect()}
    assert len(got) == len(sf_rows)
    for i, t in sf_rows:
        want = brute_spans(t)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        n = Counter(k for k, _, _ in want)
        assert got[i]["base_sha256"] == digest
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [n[k] for k in PATTERNS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(got[i]["spans"].split(","))


def test_pii_model_on_unseen_examples():
    m, held = pii.model(), pii.examples(77, 2000)
    x, y = m.table(held)
    p = 1 / (1 + pii.np.exp(-(m.a * m.trees.score(x) + m.b)))
    picked = p >= pii.np.array([m.thresholds[e[1]] for e in held])
    assert y[picked].mean() > 0.97 and picked[y == 1].mean() > 0.93


def test_pii_gates_lose_no_candidate():
    r = random.Random(31)
    bits = ["joe", " at ", "[at] ", "(AT) ", " dot ", "[dot]", ".com", "example", " ", "dead:", "::", "beef",
            "QwErTyUiOpAsDfGh", "12", "123-45-6789", "DE44", "5001 0517 5407", "-", "\u0130", "."]
    for _ in range(20_000):
        t = "".join(r.choice(bits) for _ in range(r.randint(1, 12)))
        assert pii.candidates(t) == [(k, *m.span()) for k, p in pii.GENERATORS.items()
                                     for m in p.finditer(t)]


def test_pii_forms_without_digits():
    found = lambda t: [(k, t[a:b]) for k, a, b, _ in pii.model().spans(t)]
    for text, want in (("please mail joe at example [dot] com today", ("email_like", "joe at example [dot] com")),
                       ("please contact joe at example.com today", ("email_like", "joe at example.com")),
                       ("server dead:beef:cafe:babe:dead:beef:cafe:babe is up",
                        ("ipv6", "dead:beef:cafe:babe:dead:beef:cafe:babe")),
                       ('the token = "QwErTyUiOpAsDfGhJkLzXcVbNm" is set',
                        ("secret", "QwErTyUiOpAsDfGhJkLzXcVbNm"))):
        assert found(text) == [want]
    for text in ("the internationalization of counterrevolutionaries", "they arrived at home.then we left",
                 "a state-of-the-art-of-writing text", "and so on ::::: end", "=" * 40):
        assert found(text) == []


def test_pii_redaction_and_edges(spark):
    text = 'mail a.b@c.org or +1 (523) 555-1055, token = "9c8b45435718dcc700c184a7e303cdc64c6a8f7f" end'
    docs = with_clashes(edge_documents(spark).unionByName(documents(spark, [(200, text)])))
    out = pii.stage(spark, docs, SF)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[200]["text"] == "mail [EMAIL] or [PHONE], token = \"[SECRET]\" end"
    assert by_id[200]["n_chars"] == len(by_id[200]["text"])
    assert [by_id[i]["text"] for i in range(12)] == edge_texts()
    assert pii.stage(spark, docs.limit(0), SF).count() == 0
    overlap = [{"kind": "ip", "start": 0, "end": 4}, {"kind": "card", "start": 2, "end": 6}]
    assert pii.redacted("abcdefgh", overlap) == "[IP]gh"


# ---------------------------------------------------------------- op3

def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if wins[w] > 1
           for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit),
            len(words) < 50 or 100 * len(hit) > 50 * len(words))


def check_quality(docs, rows):
    got = sorted(tuple(r) for r in quality.measures(docs).withColumn(
        "f", quality.base_failed()).fillna(-1, ["id"]).select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "f").collect())
    assert got == sorted((-1 if i is None else i, *brute_quality(t)) for i, t in rows)


def test_quality_counts(spark, sf_rows):
    check_quality(spark.read.parquet(f"{SF}/documents.parquet"), sf_rows)
    r = random.Random(3)
    rows = [(i, " ".join(r.choice("ab") for _ in range(r.randint(0, 30)))) for i in range(200)]
    rows += [(500 + i, "\n".join(r.choice(["x y", "", " ", "x y ", "\tz"]) for _ in range(9)))
             for i in range(50)]
    check_quality(documents(spark, rows), rows)
    edge = edge_documents(spark)
    check_quality(with_clashes(edge), [(x[0], x[1]) for x in edge.collect()])


def test_binomial_tail_is_exact(spark):
    from math import comb

    from pyspark.sql import functions as F
    cases = [(k, n, p) for n in (1, 7, 40, 400) for k in (0, 1, 3, 9, 30) if k <= n for p in (0.02, 0.2)]
    for p in (0.02, 0.2):
        rows = [(k, n) for k, n, q in cases if q == p]
        got = spark.createDataFrame(rows, "k long, n long").select(
            "k", "n", quality.binomial_tail(F.col("k"), F.col("n"), p).alias("t")).collect()
        for r in got:
            want = sum(comb(r["n"], i) * p ** i * (1 - p) ** (r["n"] - i) for i in range(r["k"] + 1))
            assert r["t"] == pytest.approx(1.0 if r["k"] >= r["n"] * p else want, rel=1e-9)


def test_quality_keeps_good_documents(spark):
    out = quality.op3_quality(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    lost = out.where("quality = 1 and not base_failed and not kept").count()
    assert lost <= quality.ALPHA * out.where("quality = 1 and not base_failed").count()
    docs = edge_documents(spark)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.judge(docs.limit(0), empty).count() == 0
    judged = quality.judge(docs, empty)
    assert judged.count() == docs.count()
    assert judged.where("kept = base_failed").count() == 0   # nothing certified


# ---------------------------------------------------------------- op5, op8

def odd_texts():
    r = random.Random(2)
    pool = lambda: chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x3000),
                                 r.randrange(0x3000, 0xd7ff), r.randrange(0xe000, 0x11000), 9, 10, 28,
                                 0x85, 0x300, 0x3a3, 0x2581]))
    return ["".join(pool() for _ in range(50)) for _ in range(200)] + [
        "don't I'LL x<|endoftext|>y <|startoftext|>", "a" * 3000 + "b" * 70, "It's'ss 'S ''re",
        "\u03a3\u03b1\u03c2 \u039f\u0394\u039f\u03a3", "\xd7\xf7\xde\xdf x\x00y\x0ez\x1bq\x7f"]


def test_bpe_equals_the_library(spark, sf_rows):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(bpe.default_path())
    texts = [t for _, t in sf_rows] + odd_texts() + edge_texts()
    want = []
    for t in texts:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    docs = with_clashes(documents(spark, enumerate(texts)))
    for lexicon in (0, 3000):
        got = sorted(tuple(r) for r in bpe.encoded(docs, lexicon=lexicon).collect())
        assert got == [(i, *w) for i, w in enumerate(want)]
    codec = bpe.Codec(docs, lexicon=100)
    back = sorted(tuple(r) for r in docs.select("doc_id", codec.encode()("text").alias("ids")).select(
        "doc_id", "ids", codec.decode()("ids").alias("back")).collect())
    for (i, ids, text), t in zip(back, texts):
        assert ids == tok.encode(t or "", add_special_tokens=False).ids
        assert text == tok.decode(ids, skip_special_tokens=False)


def test_lexicon_shares_suffixes():
    words = {w.encode(): [i] for i, w in enumerate("running walking talking talk walk run".split())}
    lex = bpe.Lexicon(bpe.compile_lexicon(words))
    assert [lex.ids(i) for i in lex.find(list(words))] == list(words.values())
    assert list(lex.find([b"", b"walks", b"ru", b"x" * 99])) == [-1] * 4
    assert len(lex.finals) < sum(map(len, words))   # fewer states than a trie
    assert list(bpe.Lexicon(bpe.compile_lexicon({})).find([b"a"])) == [-1]


def test_pieces_are_merged_together_as_one_by_one():
    r = random.Random(5)
    words = {"".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(1, 60))) for _ in range(5000)}
    words |= {w for t in odd_texts() for w in bpe.WordBpe(bpe.default_path()).pieces(t)}
    enc = bpe.Encoder(bpe.default_path(), bpe.compile_lexicon({}))
    words = [w for w in sorted(words) if w not in enc.bpe.special]
    for w, ids in zip(words, enc.encode_all(words)):
        if enc.bpe.pieces(w) == [w]:
            assert ids.tolist() == enc.bpe.merge(w), w
    assert list(enc.bpe.merge_all([], [])) == []


def test_a_remembered_piece_takes_little_memory(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ROWS", 30_000)
    r = random.Random(6)
    texts = [" ".join("".join(r.choice("etaoinshrdlu") for _ in range(9)) for _ in range(100)) for _ in range(250)]
    enc = bpe.Encoder(bpe.default_path(), bpe.compile_lexicon({}))
    first = [x.tobytes() for x in enc.encode_all(texts[:50])]
    tracemalloc.start()
    for x in enc.encode_all(texts):
        del x
    used = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert used < 20_000 * 210          # 247 bytes a piece with ids and tokens kept as text
    for _ in range(3):                  # generations change, ids stay
        again = [x.tobytes() for x in enc.encode_all(texts)]
    assert again[:50] == first


def test_token_counts_equal_the_library(spark, sf_rows):
    from tokenizers import Tokenizer, models, pre_tokenizers
    uni = Tokenizer(models.Unigram(tokcount.vocabulary(tokcount.default_path()), 0, False))
    uni.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace("\u2581", "always", True)])
    texts = [t for _, t in sf_rows] + odd_texts() + edge_texts()
    docs = documents(spark, enumerate(texts))
    got = sorted(tuple(r) for r in docs.select("doc_id", tokcount.counter()("text")).collect())
    assert got == [(i, len(uni.encode(t or "", add_special_tokens=False).ids))
                   for i, t in enumerate(texts)]


# ---------------------------------------------------------------- op9

def test_decontamination(spark, sf_rows):
    bench = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select(
        "item_id", "text").collect()]
    got = sorted(tuple(r) for r in decontam.op9_decontaminate(spark, SF).collect())
    assert got == sorted(decontam.brute_force(sf_rows, bench))
    assert any(r[-1] for r in got)


def test_decontamination_edges_and_blocks(spark):
    r = random.Random(8)
    bench = [(1, prose(r, 40)), (2, "just five small little words"), (3, None), (4, "?!"),
             (5, "a a a a a a a a a a a a a a a"), (6, "just five small little words"), (1, "other text")]
    docs = [(i, t) for i, t in enumerate(edge_texts())] + [
        (20, "x " + bench[0][1] + " y"), (21, "and JUST five, small little words! " + prose(r, 200)),
        (22, "a " * 50), (23, prose(r, 10_000) + " " + bench[0][1]), (None, bench[1][1])]
    bench_df = spark.createDataFrame(bench, "item_id long, text string")
    docs_df = with_clashes(documents(spark, docs)).drop("hits")
    want = decontam.brute_force(docs, bench)
    for block in (decontam.BLOCK, 10):
        out = decontam.with_hits(docs_df, bench_df, block=block)
        got = [(x["doc_id"], x["hits"]["n_words"], x["hits"]["n_hit"], len(x["hits"]["items"]),
                hashlib.sha256(",".join(x["hits"]["items"]).encode()).hexdigest())
               for x in out.collect()]
        assert sorted(got, key=str) == sorted((w[:5] for w in want), key=str)
        spans = {x["doc_id"]: [x["text"][s["start"]:s["end"]] for s in x["hits"]["spans"]]
                 for x in out.collect()}
        assert spans[21] == ["JUST five, small little words"]
    none = decontam.with_hits(docs_df, bench_df.limit(0))
    assert none.where("hits.n_hit > 0").count() == 0 and none.count() == len(docs)
    assert decontam.with_hits(docs_df.limit(0), bench_df).count() == 0


# ---------------------------------------------------------------- op10

def test_sharding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = shard.op10_shard(spark, SF).collect()
    assert len(rows) == len(text)
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert r["grown_shard"] in (r["shard"], 8)
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(
            range(sum(r["shard"] == s for r in rows)))
    assert any(r["grown_shard"] == 8 for r in rows)


def test_shard_weights_move_rows_only_within_changed_subtrees(spark):
    from pyspark.sql import functions as F
    ids = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    heavy = {**shard.TREE, "r1": {"k0": {4: 1.0, 5: 3.0}, "k1": shard.TREE["r1"]["k1"]}}
    moved = ids.select(shard.descend(F.col("k"), shard.TREE).alias("a"),
                       shard.descend(F.col("k"), heavy).alias("b")).groupBy("a", "b").count().collect()
    n = {(r["a"], r["b"]): r["count"] for r in moved}
    # region r1 grew: nothing moves inside r0, and nothing leaves r1
    assert all(a == b or b >= 4 for a, b in n)
    assert all(not (a >= 6 and b >= 6) or a == b for a, b in n)
    share = sum(c for (a, b), c in n.items() if b == 5) / 20_000
    assert abs(share - (6 / 10) * (4 / 6) * (3 / 4)) < 0.02


def test_sharding_edges(spark):
    docs = with_clashes(edge_documents(spark))
    out = shard.assign(docs).collect()
    assert len(out) == docs.count()
    assert {(r["size"], r["text_crc32"]) for r in out if r["doc_id"] in (0, 1)} == {(1, 0)}
    assert len({r["shard"] for r in out if r["doc_id"] == 3}) == 1
    assert shard.assign(docs.limit(0)).count() == 0
