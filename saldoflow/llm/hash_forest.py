"""Nearest neighbours by largest inner product, with a forest of hash prefixes.

Vectors are scaled to length 1 at most and get one more component that makes it 1, so that the nearest by
inner product are the nearest by angle. Each of ``TREES`` trees gives a vector a string of
``BITS`` signs against random planes and keeps all strings sorted. The sorted arrays are
dealt out by their first bits in cells of about ``CELL`` vectors, and a cell with more is split.

A query descends in every tree to the cell of its own string and takes the longest prefix that it shares with
some rows there, which gives a first idea of its nearest. Then it ascends in all trees at once to the level at
which a vector as near as the last of these shares a prefix in some tree with probability ``FOUND``, and all
vectors that share a prefix of that length are compared. The level follows from the vectors
alone, so nothing caps the candidates: if nothing is near, a query compares all of them.

Vectors that are null or zero or hold a null, NaN or infinite component take no part; one that is shorter than
others counts as followed by zeros. Equal vectors are looked for once; of each, as many ids as can be
among the nearest are kept, the smallest, which loses nothing as ties go to them. Rows that repeat id and vector
count once; rows of one id with different vectors are queries and candidates of their own; a null id is a candidate, after all others, but no query. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

TREES, BITS, CELL, FOUND, SEED = 12, 32, 2048, 0.93, 20
#: Rows that share a query's longest prefix in a cell, at least.
DESCENT = 128
_QUERIES = 256  # compared with a cell at a time

POINT, QUERY = 0, 1
BLOCK_ROW = "tree int, cell bigint, part int, kind int, hash bigint, level int, least double, gid bigint, vec binary"
FOUND_ROW = "query bigint, gid bigint, score double"


def _binary(kind: str) -> Callable:
    """Valid vectors as bytes, without trailing zeros, and their squared lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            at, data, norms = [], [], []
            for i, vector in enumerate(column):
                if not vector.is_valid:
                    continue
                values = np.asarray(vector.values.to_numpy(zero_copy_only=False), kind) + 0  # no negative zero
                used = np.flatnonzero(values)
                if len(used) and np.isfinite(values).all():
                    values = values[:used[-1] + 1].astype("f8")
                    at.append(i)
                    data.append(values.astype(kind).tobytes())
                    norms.append(float(values @ values))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at, pa.int64())), pa.array(data, pa.binary()), pa.array(norms, pa.float64())], ["id", "vec", "norm2"])

    return run


def planes(width: int, seed: int = SEED) -> np.ndarray:
    """Random planes for vectors of ``width`` components and the additional one, by tree and bit."""
    return np.random.default_rng(seed).standard_normal((width + 1, TREES * BITS))


def _matrix(vectors: list[bytes], kind: str, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        values = np.frombuffer(v, kind)
        row[:len(values)] = values
    return out


def strings(matrix: np.ndarray, norms2: np.ndarray, most2: float, queries: bool) -> np.ndarray:
    """Hash strings, as numbers in the order of the strings, by row and tree.

    The additional component fills a vector up to the largest length; a query has none.
    """
    scale = norms2 if queries else np.full(len(matrix), most2)
    rest = np.zeros(len(matrix)) if queries else np.sqrt(np.maximum(0.0, 1 - norms2 / most2))
    whole = np.column_stack([matrix / np.sqrt(scale)[:, None], rest])
    bits = (whole @ planes(matrix.shape[1]) > 0).reshape(len(matrix), TREES, BITS)
    return bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _strung(kind: str, width: int, most2: float, queries: bool) -> Callable:
    """``gid, level, least, norm2, vec`` to one row per tree, with its hash string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                matrix = _matrix(piece.column("vec").to_pylist(), kind, width)
                hashes = strings(matrix, piece.column("norm2").to_numpy(zero_copy_only=False), most2, queries)
                rows = pa.array(np.repeat(np.arange(len(matrix)), TREES))
                trees = pa.array(np.tile(np.arange(TREES, dtype=np.int32), len(matrix)))
                yield pa.RecordBatch.from_arrays(
                    [trees, pa.array(hashes.ravel()), *[piece.column(c).take(rows) for c in ("gid", "level", "least", "vec")]],
                    ["tree", "hash", "gid", "level", "least", "vec"])

    return run


def descend(hashes: np.ndarray, own: int, wanted: int) -> tuple[int, int]:
    """Range of sorted ``hashes`` that share the longest prefix with ``own`` which ``wanted`` of them share."""
    wanted = min(wanted, len(hashes))
    for level in range(BITS, -1, -1):
        low = own >> (BITS - level) << (BITS - level)
        a, b = np.searchsorted(hashes, [low, low + (1 << (BITS - level))])
        if b - a >= wanted:
            return int(a), int(b)
    return 0, len(hashes)


def _best(points: tuple, queries: list[dict], kind: str, width: int, top: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The best of a block's points for each query: queries, gids and exact scores.

    A query with a level takes the points that share a prefix of that length, one without descends.
    """
    hashes, gids, matrix = points
    ranges: dict[tuple[int, int], list[int]] = {}
    for i, q in enumerate(queries):
        if q["level"] is None:
            span = descend(hashes, q["hash"], DESCENT)
        else:
            free = BITS - q["level"]
            low = q["hash"] >> free << free
            span = tuple(int(x) for x in np.searchsorted(hashes, [low, low + (1 << free)]))
        if span[0] < span[1]:
            ranges.setdefault(span, []).append(i)
    vectors = _matrix([q["vec"] for q in queries], kind, width)
    least = np.array([-np.inf if q["least"] is None else q["least"] for q in queries])
    ids = np.array([q["gid"] for q in queries])
    for (a, b), members in ranges.items():
        scores = vectors[members] @ matrix[a:b].T
        slack = 1e-9 * (1 + np.abs(scores).max())  # the exact scores decide
        if b - a > 2 * top:
            cut = np.partition(scores, b - a - top, axis=1)[:, b - a - top]
        else:
            cut = np.full(len(members), -np.inf)
        r, c = np.nonzero(scores >= np.maximum(cut, least[members])[:, None] - slack)
        if len(r):
            rows = np.array(members)[r]
            exact = np.empty(len(r))
            for start in range(0, len(r), 4096):  # summed in order, whatever the block
                part = slice(start, start + 4096)
                exact[part] = np.cumsum(vectors[rows[part]] * matrix[a + c[part]], axis=1)[:, -1]
            yield ids[rows], gids[a + c], exact


def _comparing(kind: str, width: int, top: int) -> Callable:
    """Blocks, each its points in order of their strings and then its queries, to ``FOUND_ROW``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, points, queries = None, [], None, []

        def compared() -> Iterator[pa.RecordBatch]:
            for q, g, s in _best(points, queries, kind, width, top):
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(g), pa.array(s)], ["query", "gid", "score"])
            queries.clear()

        for batch in batches:
            for row in batch.to_pylist():
                here = (row["tree"], row["cell"], row["part"])
                if here != block:
                    if queries:
                        yield from compared()
                    block, held, points = here, [], None
                if row["kind"] == POINT:
                    held.append((row["hash"], row["gid"], row["vec"]))
                elif held:
                    if points is None:
                        points = (np.array([h[0] for h in held]), np.array([h[1] for h in held]),
                                  _matrix([h[2] for h in held], kind, width))
                    queries.append(row)
                    if len(queries) >= _QUERIES:
                        yield from compared()
        if queries:
            yield from compared()

    return run


class HashForest:
    """The index of all vectors of a table ``(id, vector)``; ``top`` is the number of neighbours wanted."""

    def __init__(self, rows: DataFrame, id_col: str, vec_col: str, top: int):
        element = rows.schema[vec_col].dataType.elementType
        self.kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
        vec = F.col(vec_col).cast("array<float>" if self.kind == "<f4" else "array<double>")
        id_type = rows.schema[id_col].dataType.simpleString()
        valid = rows.select(F.col(id_col).alias("id"), vec.alias("vec")).mapInArrow(
            _binary(self.kind), f"id {id_type}, vec binary, norm2 double")
        self.top = top
        # One id more than wanted, as the query's own may be among them.
        first = Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last())
        self.rows = stored(valid.dropDuplicates(["id", "vec"]))
        kept = self.rows.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= top + 1)
        grouped = kept.groupBy("vec", "norm2").agg(F.array_sort(F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id"))).alias("ids"))
        self.vectors = stored(grouped.select(F.monotonically_increasing_id().alias("gid"), "vec", "norm2", "ids"))
        n, most2, bytes_ = self.vectors.agg(F.count("*"), F.max("norm2"), F.max(F.length("vec"))).first()
        self.most2, self.width = most2 or 1.0, (bytes_ or 0) // int(self.kind[-1])
        self.depth = max(0, n // CELL).bit_length()

    def _strung(self, vectors: DataFrame, queries: bool) -> DataFrame:
        return vectors.select("gid", "level", "least", "norm2", "vec").mapInArrow(
            _strung(self.kind, self.width, self.most2, queries),
            "tree int, hash bigint, gid bigint, level int, least double, vec binary")

    def _compared(self, queries: DataFrame) -> DataFrame:
        """``FOUND_ROW`` of ``queries(gid, level, least, norm2, vec)``, in each block it has to visit."""
        none = {"level": F.lit(None).cast("int"), "least": F.lit(None).cast("double")}
        points = self._strung(self.vectors.withColumns(none), False)
        low = BITS - self.depth
        cell = F.shiftright("hash", low).alias("cell")
        points = points.withColumn("cell", cell)
        sizes = stored(points.groupBy("tree", "cell").agg(F.count("*").alias("n")).filter(f"n > {2 * CELL}").select(
            "tree", "cell", F.ceil(F.col("n") / CELL).cast("int").alias("parts")))
        parts = F.coalesce("parts", F.lit(1))
        points = join_splittable(points, sizes, ["tree", "cell"]).select(
            "tree", "cell", F.pmod(F.xxhash64("gid"), parts).cast("int").alias("part"), F.lit(POINT).alias("kind"), "hash",
            "level", "least", "gid", "vec")
        asked = self._strung(queries, True)
        # A level above the cells' covers several of them.
        free = F.greatest(F.lit(0), self.depth - F.coalesce("level", F.lit(self.depth)))
        first = F.expr(f"shiftleft(shiftright(hash, {low} + free), free)")
        asked = asked.withColumn("free", free).withColumn("first", first).withColumn(
            "cell", F.explode(F.expr("sequence(first, first + shiftleft(1L, free) - 1)")))
        asked = join_splittable(asked, sizes, ["tree", "cell"])
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).select(
            "tree", "cell", "part", F.lit(QUERY).alias("kind"), "hash", "level", "least", "gid", "vec")
        blocks = points.unionByName(asked).repartition("tree", "cell", "part").sortWithinPartitions("tree", "cell", "part", "kind", "hash")
        return blocks.mapInArrow(_comparing(self.kind, self.width, self.top + 1), FOUND_ROW)

    def _first(self, found: DataFrame, order: list[Column]) -> DataFrame:
        """The ``top + 1`` first of each query, each vector once."""
        ranked = F.row_number().over(Window.partitionBy("query").orderBy(*order))
        return found.dropDuplicates(["query", "gid"]).withColumn("nth", ranked).filter(F.col("nth") <= self.top + 1)

    def search(self, asked: DataFrame) -> DataFrame:
        """``query_id``, ``rank``, ``id`` and ``score`` of the nearest of each id of ``asked(id, vec)``, rows of this index."""
        plain = asked.select(F.col("id").alias("query_id"), "vec")
        own = self.vectors.select("vec", "gid")
        who = stored(join_splittable(plain, own, ["vec"], "inner").select("query_id", "gid"))
        queries = stored(self.vectors.join(who.select("gid").distinct(), "gid", "left_semi").select("gid", "norm2", "vec"))
        none = {"level": F.lit(None).cast("int"), "least": F.lit(None).cast("double")}
        found = stored(self._compared(queries.withColumns(none)))
        first = self._first(found, [F.col("score").desc(), F.col("gid")])
        last = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(
            F.col("n") == self.top + 1).select(F.col("query").alias("gid"), "least")
        # The level at which a vector at this angle shares a prefix with the query in some tree.
        cosine = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("least") / F.sqrt(F.col("norm2") * self.most2)))
        alike = 1 - F.acos(cosine) / np.pi
        share = float(np.log(1 - (1 - FOUND) ** (1 / TREES)))
        level = F.when(alike >= 1, BITS).when(alike <= 0, 0).otherwise(
            F.least(F.lit(BITS), F.floor(share / F.log(alike)).cast("int")))
        again = queries.join(last, "gid", "left").withColumn("level", F.coalesce(level, F.lit(0)).cast("int"))
        found = found.unionByName(self._compared(again))
        ids = self.vectors.select("gid", "ids")
        named = join_splittable(found.dropDuplicates(["query", "gid"]), ids, ["gid"], "inner")
        order = [F.col("score").desc(), F.col("ids")[0]]
        best = named.withColumn("nth", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("nth") <= self.top + 1)
        listed = best.select("query", "score", (F.col("gid") == F.col("query")).alias("same"), F.explode("ids").alias("other"))
        nearest = Window.partitionBy("query").orderBy(F.col("score").desc(), "other")
        listed = stored(listed.withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= self.top + 1)
                        .select(F.col("query").alias("gid"), "score", "same", F.col("other.id").alias("id")))
        both = join_splittable(who, listed, ["gid"], "inner").filter(~(F.col("same") & F.col("id").eqNullSafe(F.col("query_id"))))
        rank = F.row_number().over(Window.partitionBy("query_id", "gid").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last()))
        return both.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= self.top).select("query_id", "rank", "id", "score")
