"""Lexical and vector search over chunks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import scores as S
from corpusengine.functions import text as T


def search(rows: DataFrame, term: str, keep: list[str], text: str = "text") -> DataFrame:
    """Rows whose text holds the term in any case (% and _ are wild cards), with a snippet round it."""
    return rows.filter(F.ilike(F.col(text), F.lit(f"%{term}%"))).select(*keep, T.snippet(F.col(text), term).alias("snippet"))


def scored(index: DataFrame, vector: str, query: list[float]) -> DataFrame:
    """index with score: the cosine with the query, 0 for a zero vector."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return index.withColumn("score", F.coalesce(S.cosine(F.col(vector), q), F.lit(0.0)))


def top_k(index: DataFrame, vector: str, query: list[float], k: int, ids: list[str]) -> DataFrame:
    """The k rows of the largest cosine, ties by ids. Each task keeps k rows; nothing is sorted as a whole."""
    return scored(index, vector, query).orderBy(F.desc("score"), *ids).limit(k)


def filtered(hits: DataFrame, rows: DataFrame, ids: list[str], k: int, *, min_score: float = 0.0, **allowed: list | None) -> DataFrame:
    """hits (a bounded number) with their rows' columns, of the scores and values that are allowed, the first k."""
    kept = hits.filter(F.col("score") >= min_score)
    columns = [c for c in rows.columns if c in ids or c not in hits.columns]
    out = rows.select(*columns).join(F.broadcast(kept), ids)  # at most the over-fetched k
    for column, values in allowed.items():
        if values:
            out = out.filter(F.col(column).isin(values))
    return out.orderBy(F.desc("score"), *ids).limit(k)


def best_per(hits: DataFrame, key: str, k: int) -> DataFrame:
    return hits.groupBy(key).agg(F.max("score").alias("score")).orderBy(F.desc("score"), key).limit(k)


def recall_at(hits: DataFrame, gold: DataFrame, k: int) -> DataFrame:
    """hits: (query, id, score), gold: (query, id) -> recall at k and mean reciprocal rank over the queries of gold."""
    from pyspark.sql.window import Window

    ranked = hits.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id")))
    found = gold.join(ranked, ["query", "id"], "left").groupBy("query").agg(F.min("rank").alias("rank"))
    return found.agg(F.avg(F.coalesce(F.col("rank") <= k, F.lit(False)).cast("double")).alias("recall"), F.avg(F.coalesce(1 / F.col("rank"), F.lit(0.0))).alias("mrr"))


#: Rows of a block of vectors and of a block of queries: two blocks and their products are what a task holds.
VECTORS, QUERIES = 8192, 512


def _in_blocks(vectors: DataFrame, queries: DataFrame, more: list[str], answer: Callable[[pa.Table, pa.Table, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """answer(vectors of a block, queries of a block, cosines) for every pair of blocks; blocks meet by equality of their pair's number."""
    sizes = [max(1, -(-df.count() // size)) for df, size in ((vectors, VECTORS), (queries, QUERIES))]
    nth = lambda key, n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    left = vectors.withColumn("vb", nth("id", sizes[0])).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(sizes[1] - 1))))
    right = queries.withColumn("qb", nth("query", sizes[1])).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(sizes[0] - 1))))

    def matrix(t: pa.Table, column: str) -> np.ndarray:
        m = np.array(t[column].to_pylist(), float).reshape(t.num_rows, -1)
        norm = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
        return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)

    def meet(v: pa.Table, q: pa.Table) -> pa.Table:
        if not v.num_rows or not q.num_rows:
            return answer(v.slice(0, 0), q.slice(0, 0), np.zeros((0, 0)))
        return answer(v, q, np.einsum("id,jd->ij", matrix(q, "asked"), matrix(v, "vector")))  # not by BLAS: equal vectors get equal scores

    keys = ["vb", "qb"]
    return left.select(*keys, "id", "label", "vector").groupBy(*keys).cogroup(right.select(*keys, "query", "want", "asked", *more).groupBy(*keys)).applyInArrow(meet, schema)


def first_ranks(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """query, rank: the place of the first vector of the query's label among all others by cosine, ties by id; no row where there is none.

    vectors: (id, label, vector); queries: (query, want, asked), each itself a vector (of the same id), which isn't its own answer.
    Two passes over blocks, the best answer and then how many are ahead of it: what is moved is a number a query and block, never a pair.
    """

    def best(v: pa.Table, q: pa.Table, score: np.ndarray) -> pa.Table:
        ids, out = v["id"].to_numpy(), []
        for k, (query, want) in enumerate(zip(q["query"].to_pylist(), q["want"].to_pylist(), strict=True)):
            hit = np.flatnonzero((v["label"].to_numpy(zero_copy_only=False) == want) & (ids != query))
            if len(hit):
                top = score[k, hit].max()
                out.append((query, top, ids[hit[score[k, hit] == top]].min()))
        return pa.table([pa.array([x[n] for x in out], t) for n, t in enumerate((pa.int64(), pa.float64(), pa.int64()))], ["query", "score", "id"])

    def ahead(v: pa.Table, q: pa.Table, score: np.ndarray) -> pa.Table:
        ids, n = v["id"].to_numpy(), []
        for k, (query, top, at) in enumerate(zip(q["query"].to_pylist(), q["top"].to_pylist(), q["at"].to_pylist(), strict=True)):
            n.append(int((((score[k] > top) | ((score[k] == top) & (ids <= at))) & (ids != query)).sum()))
        return pa.table([q["query"].cast(pa.int64()), pa.array(n, pa.int64())], ["query", "n"])

    found = _in_blocks(vectors, queries, [], best, "query long, score double, id long")
    first = found.groupBy("query").agg(F.max(F.struct("score", (-F.col("id")).alias("back"))).alias("m"))
    known = queries.join(first.select("query", F.col("m.score").alias("top"), (-F.col("m.back")).alias("at")), "query")
    return _in_blocks(vectors, known, ["top", "at"], ahead, "query long, n long").groupBy("query").agg(F.sum("n").alias("rank"))
