"""Vector column expressions: pooling, L2 normalisation, cosine, hash encoder.

Vectors are ``array<double>`` (or ``array<float>``); token vectors of one
text are ``array<array<...>>``.  All higher-order SQL functions, no UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POOLING = ("mean", "cls", "max")
HASH_DIM = 16  # one dimension per byte of an md5 digest


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(expr, fn) -> Column:
    """Evaluate ``expr`` once and hand it to ``fn`` as a lambda variable.

    Higher-order functions re-evaluate a column expression at every use
    inside a lambda; binding it through a one-element ``transform`` keeps
    pooling and normalisation linear in the vector size.
    """
    return F.element_at(F.transform(F.array(expr), fn), 1)


def check_pooling(strategy: str) -> str:
    if strategy not in POOLING:
        raise ValueError(f"pooling is one of {', '.join(POOLING)}, not {strategy!r}")
    return strategy


def pool_tokens(token_vectors, strategy: str = "mean") -> Column:
    """Reduce the token vectors of one text to one vector.

    ``mean`` averages every dimension over the tokens, ``max`` takes the
    per-dimension maximum, ``cls`` the first token's vector.  No tokens
    gives an empty vector.
    """
    check_pooling(strategy)
    return let(_c(token_vectors), lambda tv: _pool(tv, strategy))


def _pool(tv, strategy):
    if strategy == "cls":
        return F.when(F.size(tv) > 0, F.transform(F.element_at(tv, 1),
                                                   lambda x: x.cast("double"))) \
                .otherwise(F.array().cast("array<double>"))
    dims = F.when(F.size(tv) > 0, F.sequence(F.lit(0), F.size(F.element_at(tv, 1)) - 1)) \
            .otherwise(F.array().cast("array<int>"))
    if strategy == "mean":
        return F.transform(dims, lambda i: F.aggregate(
            tv, F.lit(0.0), lambda acc, v: acc + v[i].cast("double")) / F.size(tv))
    return F.transform(dims, lambda i: F.aggregate(
        tv, F.element_at(tv, 1)[i].cast("double"),
        lambda acc, v: F.greatest(acc, v[i].cast("double"))))


def l2_normalize(v) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    return let(_c(v), lambda vv: let(
        F.sqrt(F.aggregate(vv, F.lit(0.0), lambda a, x: a + x.cast("double") * x)),
        lambda norm: F.transform(vv, lambda x: F.when(norm > 0, x.cast("double") / norm)
                                 .otherwise(F.lit(0.0)))))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y),
                       F.lit(0.0), lambda s, z: s + F.coalesce(z, F.lit(0.0)))


def cosine(a, b) -> Column:
    """Cosine similarity; 0 when either side is empty or zero."""
    return let(_c(a), lambda va: let(_c(b), lambda vb: _cos(va, vb)))


def _cos(a, b):
    na = F.sqrt(dot(a, a))
    nb = F.sqrt(dot(b, b))
    return F.when((na > 0) & (nb > 0), dot(a, b) / (na * nb)).otherwise(F.lit(0.0))


def hash_token_vectors(tokens) -> Column:
    """Deterministic 16-dim vector per token from its md5 digest bytes.

    Byte ``b`` of the digest becomes ``(b - 127.5) / 127.5``.  It runs the
    same in DuckDB, so the oracle can recompute every embedding.
    """
    # seven bytes of the digest at a time as one number; a byte's value comes from a constant array
    values = F.array(*[F.lit((b - 127.5) / 127.5) for b in range(256)])

    def vector(h):
        parts = F.array(*[F.conv(h.substr(F.lit(2 * i + 1), F.lit(14)), 16, 10).cast("long")
                          for i in range(0, HASH_DIM, 7)])
        last = lambda i: min(i // 7 * 7 + 7, HASH_DIM) - 1
        return let(parts, lambda p: F.array(*[
            F.get(values, F.shiftright(p[i // 7], 8 * (last(i) - i)).bitwiseAND(F.lit(255)).cast("int"))
            for i in range(HASH_DIM)]))

    return F.transform(_c(tokens), lambda t: let(F.md5(t), vector))
