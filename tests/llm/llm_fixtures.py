"""Small tables for the operator tests."""

from __future__ import annotations

import random

SYLLABLES = "the an er on re ti es or ha en nd ou ea ing ed st ly ble wh sh".split()

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def word(r: random.Random) -> str:
    return "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4)))


def prose(r: random.Random, n: int) -> str:
    out, line = [], []
    for i in range(n):
        line.append(word(r))
        if r.random() < 0.05:
            line[-1] += ".\n" if r.random() < 0.3 else ","
    return " ".join(line + out)


def edited(r: random.Random, text: str, n: int) -> str:
    w = text.split(" ")
    for i in r.sample(range(len(w)), min(n, len(w))):
        w[i] = word(r) + "x"
    return " ".join(w)


def edge_texts() -> list[str | None]:
    """Null, empty, blank, tiny, repeated and odd texts."""
    return [None, "", " \n\t ", "one", "two words", "one", "Three Little Words", "three little words",
            "\u00e9t\u00e9 \u00c5ngstr\u00f6m \u65e5\u672c\u8a9e \U0001f389 \u00a0x", "a\x0bb\x1cc\x85d",
            "!!! ??? ...", "\n\n\n"]


def documents(spark, rows):
    """(doc_id, text) rows with the other columns of ``documents``."""
    return spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows], DOC_SCHEMA)


def edge_documents(spark):
    """Edge texts, a null id, repeated rows and a very long text."""
    r = random.Random(5)
    rows = list(enumerate(edge_texts()))
    rows += [(None, "no id here"), (3, "one"), (3, "one"), (100, prose(r, 60_000))]
    return documents(spark, rows)


def with_clashes(df):
    """The same rows with extra columns named like internal ones."""
    from pyspark.sql import functions as F
    names = ["uid", "id", "root", "key", "n", "sig", "node", "hits", "_hits", "_p", "_spans", "_uid",
             "_text_key", "_merged", "spans", "shard", "slot", "bucket", "row", "stratum", "size", "raw"]
    return df.select("*", *[F.lit(f"extra {c}").alias(c) for c in names])


def save(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
