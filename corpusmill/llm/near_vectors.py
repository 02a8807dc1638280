"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

Equal vectors of a label become one node with a count.  Each of `tables` hash functions turns a vector three times by
random signs and a Hadamard transform and takes the signed coordinate of largest size, `depth` such values side by side
(more for more rows).  A vector stands in its own bucket and visits the buckets that lose least.  Buckets of more than
`block` vectors are dealt out as pairs of blocks, so no task holds more than two blocks, and none is capped.  Signatures are
written once a vector; a visit carries the vector as wide as it came and the signature in as few bytes as its codes need.

Candidates are verified by cosine in double precision.  No pair leaves its task: a pair counts in the first table and
bucket in which it meets, which both signatures show, so tasks return link counts and the edges of a spanning forest."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import partitions, written
from corpusmill.operators.graph import components

HASHED = "label long, dim int, rid long, mult long, vector binary, sig binary, buckets array<long>"
FOUND = "rid long, n long, root long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, of a power of two of columns, scaled to keep lengths."""
    n, d = x.shape
    x = x.copy()
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def probes_of(units: np.ndarray, table: int, depth: int, probes: int, seed: int) -> np.ndarray:
    """Bucket numbers (n x probes) in one table: the own one, then those that lose least."""
    n, d = units.shape
    wide = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = units
    ranks = min(probes, wide)
    codes, losses = np.empty((n, depth, ranks), np.int64), np.empty((n, depth, ranks))
    for k in range(depth):
        signs = np.random.default_rng([seed, table, k, wide]).integers(0, 2, (3, wide)) * 2.0 - 1
        x = padded
        for s in signs:
            x = hadamard(x * s)
        size = np.abs(x)
        top = np.argsort(-size, axis=1, kind="stable")[:, :ranks]
        best = np.take_along_axis(size, top, 1)
        codes[:, k] = 2 * top + (np.take_along_axis(x, top, 1) < 0)
        losses[:, k] = best[:, :1] ** 2 - best**2
    weights = (2 * wide) ** np.arange(depth)
    own = (codes[:, :, 0] * weights).sum(1)
    others = (own[:, None, None] + (codes[:, :, 1:] - codes[:, :, :1]) * weights[:, None]).reshape(n, -1)
    cheap = np.argsort(losses[:, :, 1:].reshape(n, -1), axis=1, kind="stable")[:, : probes - 1]
    return np.concatenate([own[:, None], np.take_along_axis(others, cheap, 1)], axis=1)


def units_of(raw: list[bytes], dim: int) -> np.ndarray:
    """Unit vectors in double precision; raw: little-endian floats of 4 or 8 bytes."""
    x = np.frombuffer(b"".join(raw), f"<f{len(raw[0]) // dim}").reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def code_type(dim: int, depth: int) -> np.dtype:
    """The narrowest type that holds bucket numbers."""
    return np.min_scalar_type((2 << max(1, (dim - 1).bit_length())) ** depth)


def hashed(tables: int, depth: int, probes: int, seed: int, width: int):
    """width: bytes of a component as it is sent on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, mult, label, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), batch.column(3)
            flat = vectors.flatten().to_numpy()
            ends = np.cumsum(vectors.value_lengths().to_numpy())
            dims = np.diff(np.r_[0, ends])
            for d in np.unique(dims).tolist():
                at = np.flatnonzero(dims == d)
                raw = [flat[ends[i] - d : ends[i]].astype(f"<f{width}").tobytes() for i in at.tolist()]
                units = units_of(raw, d)
                sig = np.stack([probes_of(units, t, depth, probes, seed) for t in range(tables)], 1)
                sigs = [x.tobytes() for x in sig.astype(code_type(d, depth))]
                per = sig.shape[1] * sig.shape[2]
                buckets = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * per, pa.int32()), pa.array(sig.reshape(-1)))
                cols = [pa.array(label[at]), pa.array(np.full(len(at), d, np.int32)), pa.array(rid[at]), pa.array(mult[at]), pa.array(raw, pa.binary()), pa.array(sigs, pa.binary()), buckets]
                yield pa.record_batch(cols, names=[c.split()[0] for c in HASHED.split(", ")])

    return run


def met_before(a: np.ndarray, b: np.ndarray, t: int, bucket: int) -> np.ndarray:
    """Whether pairs of signatures (n x tables x probes) meet in an earlier table, or in this one in a lesser bucket."""
    met = (a[:, :t, :1] == b[:, :t]).any((1, 2)) | (b[:, :t, :1] == a[:, :t]).any((1, 2))
    for x, y in ((a, b), (b, a)):
        met |= (x[:, t, 0] < bucket) & (x[:, t, :1] == y[:, t]).any(1)
    return met


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Least member of each of n nodes' component under the edges u, v."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verify(threshold: float, tables: int, depth: int):
    def group(key: tuple, rows: list[tuple]) -> pa.RecordBatch | None:
        t, bucket, i, j = key[0], key[3], key[4], key[5]
        own = np.array([r[0] for r in rows])
        rid, mult = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        units = units_of([r[3] for r in rows], key[2])
        sig = np.frombuffer(b"".join([r[4] for r in rows]), code_type(key[2], depth)).reshape(len(rows), tables, -1)
        salt = np.array([r[5] for r in rows])
        us, vs = [], []
        for a in range(0, len(rows), 1024):
            for b in range(a, len(rows), 1024):
                near = units[a : a + 1024] @ units[b : b + 1024].T >= threshold
                u, v = np.nonzero(near)
                u, v = u + a, v + b
                keep = (u < v) & (own[u] | own[v])
                if i != j:
                    keep &= salt[u] != salt[v]
                us.append(u[keep])
                vs.append(v[keep])
        u, v = np.concatenate(us), np.concatenate(vs)
        if not len(u):
            return None
        new = np.empty(len(u), bool)
        for a in range(0, len(u), 100_000):
            new[a : a + 100_000] = ~met_before(sig[u[a : a + 100_000]], sig[v[a : a + 100_000]], t, bucket)
        u, v = u[new], v[new]
        if not len(u):
            return None
        n = np.bincount(u, mult[v], len(rows)) + np.bincount(v, mult[u], len(rows))
        root = forest(len(rows), u, v)
        at = np.flatnonzero(n)
        return pa.record_batch([pa.array(rid[at]), pa.array(n[at].astype(np.int64)), pa.array(rid[root[at]])], names=["rid", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in range(12)]
            for r in zip(*cols, strict=True):
                if r[:6] != key:
                    if len(rows) > 1 and (out := group(key, rows)):
                        yield out
                    key, rows = r[:6], []
                rows.append(r[6:])
        if len(rows) > 1 and (out := group(key, rows)):
            yield out

    return run


def near_vectors(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, tables: int | None = None, depth: int | None = None, probes: int = 3, block: int = 2048, seed: int = 42, most_broadcast: int = 100_000
) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of vectors.

    Vectors with equal labels link when their cosine is at least `threshold`.  Vectors that are null, empty, zero or hold
    null or non-finite components, and those with a null label, link with nothing; neither do vectors of different
    lengths.  Equal vectors link with each other.  component_id is the least id that links reach; rows with a null id
    take part and don't count as least.  Rows that repeat are vectors like others.  An empty table gives no rows.
    depth: hash values in a bucket's number, by default as many as keep buckets near a thousand vectors."""
    spark = vectors.sparkSession
    x = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.col(label_col).cast("long").alias("label"))
    good = x.isNotNull() & F.col("label").isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))) & F.exists(x, lambda e: e != 0)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False))).withColumn("v", F.when(F.col("good"), F.transform(x, lambda e: e + 0.0)))
    rows = rows.withColumn("rid", F.when(F.col("good"), F.xxhash64("label", "v")))
    nodes = written(rows.filter("good").groupBy("rid", "label", "v").agg(F.count("*").alias("mult"), F.min("vec_id").alias("least")), "vectors")
    total, wide = nodes.agg(F.count("*"), F.max(F.size("v"))).first()
    depth = depth or max(1, round(math.log(max(total, 1) / 1000) / math.log(2 * (wide or 2)))) if total else 1
    tables = tables or 6 * depth
    width = 4 if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else 8
    known = written(nodes.select("rid", "mult", "label", "v").mapInArrow(hashed(tables, depth, probes, seed, width), HASHED), "signatures")
    per = F.col("size") / tables
    visited = known.select("*", F.size("buckets").alias("size"), F.posexplode("buckets").alias("j", "bucket")).withColumns({"t": F.floor(F.col("j") / per).cast("int"), "own": F.col("j") % per == 0}).drop("buckets", "size", "j")
    keys = ["t", "label", "dim", "bucket"]
    large = visited.groupBy(*keys).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")).filter("blocks > 1").checkpoint()
    large = F.broadcast(large) if large.count() <= most_broadcast else large
    salted = visited.join(large, keys, "left").fillna(1, ["blocks"]).withColumn("salt", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    dealt = salted.select("*", other).select(*keys, F.least("salt", "o").alias("i"), F.greatest("salt", "o").alias("j"), "own", "rid", "mult", "vector", "sig", "salt")
    keys += ["i", "j"]
    found = written(dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(verify(threshold, tables, depth), FOUND), "links")
    counts = found.groupBy("rid").agg(F.sum("n").alias("linked"))
    roots = components(found.select(F.col("rid").alias("u"), F.col("root").alias("v"))).select(F.col("node").alias("rid"), "root")
    full = nodes.select("rid", "mult", "least").join(counts, "rid", "left").join(roots, "rid", "left").withColumn("root", F.coalesce("root", "rid"))
    least = full.groupBy("root").agg(F.min("least").alias("component_id"))
    out = full.join(least, "root").select("rid", (F.coalesce("linked", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id")
    # written, so that the rows of a vector that very many repeat can be split
    out = written(out, "components")
    return rows.join(out, "rid", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.when(F.col("good"), F.col("component_id")).otherwise(F.col("vec_id")), F.lit(False)).alias("kept"),
    )


def op2_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id))::BIGINT AS component_id,
  e.vec_id <= coalesce(c.m, e.vec_id) AS kept
FROM embeddings e
LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY u) n ON n.u = e.vec_id
LEFT JOIN (SELECT u, min(v) AS m FROM reach GROUP BY u) c ON c.u = e.vec_id
"""
