"""Chat formatting, conversation repair and the Merkle manifest against plain Python."""

import hashlib
import random
import zlib

import pytest
from llm_fixtures import DOC_SCHEMA, documents, edge_documents, prose, save, with_clashes
from pyspark.sql import functions as F

from skulink.llm import chatformat, merkle, repair

CONV_SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["<|", "<\\|", "<\\\\|x", "<|im_end|>", "<|im_part|>\n", "<", "\\", "", None, "|>", "é\U0001f389 <|im_sep|>", "ok."]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def conversations(spark, rows):
    return spark.createDataFrame(rows, CONV_SCHEMA)


def odd_conversations():
    """Control strings, nulls in every column, repeated rows, equal turns, a long text, a long conversation."""
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "assistant", "assistant", "system", "tool", None, "a<|b", ""]), r.choice(ODD))
            for c in range(12) for t in range(r.randint(1, 9))]
    rows += [(50, 1, "user", "same"), (50, 1, "user", "same"), (50, None, "user", "no turn"), (50, 1, "assistant", "tie"),
             (None, 0, "user", "nobody"), (None, 1, "assistant", None), (51, 0, "user", prose(r, 40_000)),
             (52, 0, None, None), (53, 0, "user", " \t\n\x0b"), (54, 0, "user", " " * 300_000)]
    rows += [(60, t, r.choice(["user", "assistant"]), r.choice(["one.", "two", "", "three!"])) for t in range(700)]
    return rows


def by_conversation(rows, order):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return {c: sorted(g, key=order) for c, g in out.items()}


def first_null(v):
    return (v is not None, v if v is not None else 0)


def chat_brute(rows):
    out = []
    rows = rows + [(-1, 0, "user", chatformat.PROBE), (-1, 1, "assistant", chatformat.PROBE)]
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows]
    for c, g in by_conversation(rows, lambda r: (first_null(r[1]), r[2], r[3])).items():
        loss = "".join(x for _, _, r, x in g if r == "assistant")
        out.append((c, len(g), sha("".join(f"{r}\n{x}\n" for _, _, r, x in g)), len(loss), sha(loss)))
    return out


def test_chat_query_reads_every_turn_back(spark, tmp_path):
    rows = odd_conversations()
    save(with_clashes(conversations(spark, rows)), tmp_path, "conversations")
    got = chatformat.op11_chat_format(spark, str(tmp_path)).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, chat_brute(rows)))
    save(conversations(spark, []), tmp_path, "conversations")
    assert [r[0] for r in chatformat.op11_chat_format(spark, str(tmp_path)).collect()] == [-1]
    assert chatformat.format_chats(conversations(spark, [])).collect() == []


def test_template_merges_turns_and_marks_trained_text(spark):
    df = conversations(spark, [(1, 0, "user", "a"), (1, 1, "user", "<|im_end|>"), (1, 2, "assistant", "b"),
                               (1, 3, "assistant", "<|c"), (1, 4, "user", "d")])
    row = chatformat.format_chats(df).first()
    text = ("<|im_start|>user<|im_sep|>a<|im_part|><\\|im_end|><|im_end|>"
            "<|im_start|>assistant<|im_sep|>b<|im_part|><\\|c<|im_end|><|im_start|>user<|im_sep|>d<|im_end|>")
    assert row.formatted == text
    assert [text[s.start:s.end] for s in row.loss_spans] == ["b", "<\\|c"]


def test_spans_and_mask_agree(spark):
    out = chatformat.format_chats(conversations(spark, odd_conversations()))
    for r in out.select("*", chatformat.split_pieces(F.col("formatted")).alias("pieces")).collect():
        assert len(r.pieces) == len(r.loss_mask) and "".join(r.pieces) == r.formatted
        kept = [p for p, m in zip(r.pieces, r.loss_mask) if m]
        assert [r.formatted[s.start:s.end] for s in r.loss_spans] == kept


# -- repair -------------------------------------------------------------------
def follows(last):
    return "a" if last == "u" else "u"


def cheapest(initials, faults):
    """(cost, audit) by dynamic programming over prefixes."""
    def inserted(best):
        for _ in range(3):
            for s, (c, a) in list(best.items()):
                best[follows(s)] = min(best.get(follows(s), (1 << 60, "")), (c + 3, a + "I"))
        return best

    best = {"": (0, "")}
    for x, f in zip(initials, faults):
        new = {}
        for s, (c, a) in inserted(dict(best)).items():
            ways = [(s, c + 4, "D")]
            if f in "-t":
                more = 3 if f == "t" else 0
                ways.append((follows(s), c + 3 + more, "R"))
                if x == follows(s) or (s == "" and x == "s"):
                    ways.append((x, c + more, "K"))
            for t, cost, e in ways:
                new[t] = min(new.get(t, (1 << 60, "")), (cost, a + e))
        best = new
    return min(v for s, v in inserted(best).items() if s in ("", "a"))


def test_search_finds_the_ascii_least_of_the_cheapest():
    r = random.Random(11)
    for i in range(4000):
        n = r.choice([31, 32, 33, 64, 65, 97]) if i % 40 == 0 else r.randint(0, 12)
        initials = [r.choice("suaut ") if r.random() < 0.5 else "ua"[j % 2] for j in range(n)]
        faults = [r.choice("bdt----") for _ in range(n)]
        audit, cost = repair.Search(initials, faults).answer()
        assert (cost, audit) == cheapest(initials, faults), (initials, faults)
        _, roles = repair.edited(audit, initials)
        assert len(roles) == sum(e != "D" for e in audit)


def repair_brute(rows):
    kept = {}
    for c, t, role, text in rows:
        kept.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if hit == 1 else "".join(ch for ch in text if ch not in ".!?") if hit == 2 else text
        kept[c] += [(c, t, "user" if hit == 4 else role, text)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for c, g in kept.items():
        g.sort(key=lambda r: (first_null(r[1]), r[2], r[3]))
        turns = [r[1] for r in g if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen = [], set()
        for _, _, role, text in g:
            end = text.rstrip(repair.SPACE)[-1:]
            faults.append("b" if not end else "d" if (role, text) in seen else "-" if end in ".!?" else "t")
            seen.add((role, text))
        initials = [(r[2] + " ")[0] for r in g]
        cost, audit = cheapest(initials, faults)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns, i, last = [], 0, ""
        for e in audit:
            if e == "K":
                last = initials[i]
                turns.append(f"{g[i][2]}:{g[i][3]}")
            elif e != "D":
                last = follows(last)
                turns.append(f"{repair.ROLES[last]}:{g[i][3] if e == 'R' else ''}")
            i += e != "I"
        out.append((c, gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
                    sha("\n".join(turns))))
    return out


def test_repair_query_against_dynamic_programming(spark, tmp_path):
    rows = odd_conversations()
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "this row is dropped."))
    save(with_clashes(conversations(spark, rows)), tmp_path, "conversations")
    got = [tuple(r) for r in repair.op13_repair(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, repair_brute(rows)))
    assert next(r for r in got if r[0] == gone) == (gone, 0, 0, 0, 0, 0, 0, "", sha(""))
    save(conversations(spark, []), tmp_path, "conversations")
    assert repair.op13_repair(spark, str(tmp_path)).collect() == []


# -- Merkle manifest -------------------------------------------------------------
def merkle_brute(rows):
    """rows (doc_id, source, lang, n_chars, text) to the contract's columns."""
    leaf = lambda r: sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def tree(hashes):
        paths, below = [[] for _ in hashes], [[i] for i in range(len(hashes))]
        while len(hashes) > 1:
            runs = [(hashes[a:a + 3], below[a:a + 3]) for a in range(0, len(hashes), 3)]
            for run, members in runs:
                for k, ids in enumerate(members):
                    for i in ids:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            hashes, below = [sha("".join(run)) for run, _ in runs], [sum(m, []) for _, m in runs]
        return hashes[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    keys = sorted(groups, key=lambda s: b"" if s is None else b"=" + s.encode())
    trees = {}
    for k in keys:
        groups[k].sort(key=lambda r: (first_null(r[0]), leaf(r)))
        trees[k] = tree([leaf(r) for r in groups[k]])
    root, tops = tree([trees[k][0] for k in keys])
    out = []
    for k, top in zip(keys, tops):
        for r, path in zip(groups[k], trees[k][1]):
            path, now = path + top, r
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                now = (*r[:4], r[4].replace("\n", ""))
            fold = leaf(now)
            for left, right in path:
                fold = sha(left + fold + right)
            out.append((r[0], leaf(r), trees[k][0], root, sha("".join(a + b for a, b in path)), fold, fold == root))
    return out


def merkle_rows(kind):
    r = random.Random(9)
    if kind == "edge":
        return [(i, t, r.choice([None, "", "s1", "é", "Z"]), r.choice([None, "en"]), r.choice([None, 7]))
                for i, t in enumerate([None, "", "a\nb\n", "\n", "x"] * 6)] + [
            (3, "same", "s1", "en", 4), (3, "same", "s1", "en", 4), (None, "no\nid", "s1", "en", 1), (None, "no id", "s1", "en", 2)]
    if kind == "one":
        return [(4, "lone\n", "s", "en", 5)]
    # one hot source above two blocks, sizes around powers of three
    sizes = {"hot": 2 * merkle.BLOCK + 5, "a": 1, "b": 2, "c": 3, "d": 4, "e": 9, "f": 10, "g": 27, "h": 28}
    ids = iter(r.sample(range(10 ** 6), sum(sizes.values())))
    return [(next(ids), prose(r, 6) + "\n", s, "en", 9) for s, n in sizes.items() for _ in range(n)]


@pytest.mark.parametrize("kind", ["edge", "one", "hot"])
def test_merkle_query_against_plain_trees(spark, tmp_path, kind):
    rows = merkle_rows(kind)
    df = spark.createDataFrame([(i, t, lang, s, n) for i, t, s, lang, n in rows], DOC_SCHEMA)
    save(with_clashes(df), tmp_path, "documents")
    got = [tuple(r) for r in merkle.op12_merkle(spark, str(tmp_path)).collect()]
    expected = merkle_brute([(i, s, lang, n, t) for i, t, s, lang, n in rows])
    if kind == "edge":        # equal rows share out their proofs in any order
        assert sorted(str(r) for r in got) == sorted(str(r) for r in expected)
    else:
        assert sorted(got) == sorted(expected)


def test_merkle_on_edge_documents_and_empty_table(spark, tmp_path):
    docs = edge_documents(spark)
    save(docs, tmp_path, "documents")
    got = [tuple(r) for r in merkle.op12_merkle(spark, str(tmp_path)).collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(str, got)) == sorted(map(str, merkle_brute(rows)))
    save(documents(spark, []), tmp_path, "documents")
    assert merkle.op12_merkle(spark, str(tmp_path)).collect() == []


def test_merkle_proof_finds_any_changed_sibling(spark):
    rows = spark.range(40).select(F.lit("t").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    out = merkle.manifest(rows)
    assert out.where(merkle.folded(F.col("hash"), F.col("path")) != F.col("root")).count() == 0
    other = F.sha2(F.lit("other"), 256)
    assert out.where(merkle.folded(other, F.col("path")) == F.col("root")).count() == 0
