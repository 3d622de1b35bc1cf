"""N-gram Jaccard join by a token-group matrix: exact links, without pairs of copies.

A document's set holds its distinct word n-grams, as 64-bit hashes. Two documents link when their
sets' Jaccard similarity reaches ``pct`` percent. The steps, each a Spark job over all documents:

1. *Candidates.* A set that links shares ``ceil(pct * n / 100)`` of its ``n`` tokens with one other set, so
   at least so many of its tokens stand in other sets at all. All tokens are dealt out to be counted,
   packed by task and target; a token that several sets of a task share is counted there and sent once,
   so a frequent one makes no large group. Only sets with enough shared tokens go on, through a
   bitmap of their digests. A bit set by chance, or a copy counted twice, costs time, not results.
2. *Tokens.* Equal sets become one node. Each node's tokens that other nodes have too are ordered
   from rare to frequent, which again gives a prefix that linked nodes share a token of.
3. *Groups.* Every node is compared with the most central node of the prefix token lists it meets most;
   components of these links partition similar documents into groups.
4. *Token-group matrix.* Each group stores the union of its members' prefix tokens with the bounds
   of its members' sizes and of how many tokens can follow. A node's overlap with any member of a
   group is at most the bound at their first common token; only groups that can reach
   the similarity are opened, and their members compared with the node.
5. The components of all links are the result.

A null or wordless text has an empty set and no links. Texts with fewer words than ``n`` have one
token, their whole sequence. Rows with a null ``doc_id`` take part in classes of equal sets, but a
component is named after a ``doc_id``, which is null only where it has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldoflow.llm import textarrays as ta
from saldoflow.llm.components import components
from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

#: Documents to a target of step 1, and most tokens that a task holds before it hands them on.
TARGET_DOCS, HELD_TOKENS = 4096, 500_000
#: Bytes of texts whose sets are made at a time.
BLOCK_BYTES = 1 << 18
#: Most bits of the broadcast bitmap (16 MB). With more candidates more bits are set by chance.
MAX_BITS = 1 << 27


def shingle_sets(block: ta.Block, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row of a block, ascending, and their number per row."""
    data = ta.lower_ascii(block.data)
    starts, ends = ta.runs(1 - ta.SPACE[data], block.offsets)
    row = ta.rows_of(starts, block.offsets)
    hashes = ta.hash_runs(data, starts, ends)
    per_row = np.bincount(row, minlength=block.last - block.first)
    first = np.cumsum(per_row) - per_row
    full = np.flatnonzero(row[:-words + 1] == row[words - 1:]) if len(row) >= words else np.zeros(0, int)
    tokens = [ta.hash_sequences([hashes[full + k] for k in range(words)])]
    rows = [row[full]]
    for n in range(1, words):
        short = np.flatnonzero(per_row == n)
        tokens.append(ta.hash_sequences([hashes[first[short] + k] for k in range(n)]))
        rows.append(short)
    token, row = np.concatenate(tokens), np.concatenate(rows)
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    return token[new], np.bincount(row[new], minlength=block.last - block.first)


def set_digests(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set, as two numbers."""
    return (ta.sums_by_row(ta.mix64(tokens ^ np.uint64(0x5851F42D4C957F2D)), counts),
            ta.sums_by_row(ta.mix64(tokens ^ np.uint64(0x14057B7EF767814F)), counts))


def _combined(token: np.ndarray, digest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which entries to send, the tokens that several sets share here, and the sets that share them."""
    order = np.argsort(token)
    again = token[order][1:] == token[order][:-1]
    grouped = np.zeros(len(token), bool)
    grouped[1:] |= again
    grouped[:-1] |= again
    send = np.ones(len(token), bool)
    some = order[grouped]
    some = some[np.lexsort((digest[some], token[some]))]
    new_token = np.ones(len(some), bool)
    new_token[1:] = token[some[1:]] != token[some[:-1]]
    new_pair = new_token.copy()
    new_pair[1:] |= digest[some[1:]] != digest[some[:-1]]
    group = np.cumsum(new_token) - 1
    several = np.bincount(group[new_pair], minlength=int(new_token.sum())) > 1
    send[some[~new_pair | several[group]]] = False
    return send, token[some[new_token]][several], digest[some[new_pair & several[group]]]


def _token_blobs(words: int, targets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tokens by target: 32 bits of each, the digest of each run of one set's tokens, and its length.

    Digest 0 stands for several sets. Targets below 0 hold digests with counts of shared tokens.
    """

    def rows(target: np.ndarray, token: np.ndarray, digest: np.ndarray, length: np.ndarray | None) -> pa.RecordBatch:
        order = np.argsort(target, kind="stable")
        target, digest = target[order], digest[order]
        some, at = np.unique(target, return_index=True)
        cut = lambda x, places: pa.array([v.tobytes() for v in np.split(x, places[1:])], pa.binary())
        if length is not None:
            return pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), cut(token, at[:1].repeat(len(at))), cut(digest, at),
                 cut(length[order].astype(np.uint32), at)], ["target", "tokens", "digests", "lengths"])
        new = np.ones(len(target), bool)
        new[1:] = (target[1:] != target[:-1]) | (digest[1:] != digest[:-1])
        start = np.flatnonzero(new)
        length = np.diff(np.append(start, len(target))).astype(np.uint32)
        runs = np.searchsorted(start, at)
        token = (token[order] // np.uint64(targets)).astype(np.uint32)
        return pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), cut(token, at), cut(digest[start], runs), cut(length, runs)],
            ["target", "tokens", "digests", "lengths"])

    def dealt(tokens: list[np.ndarray], digests: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        token, digest = np.concatenate(tokens), np.concatenate(digests)
        send, several, sharing = _combined(token, digest)
        token = np.concatenate([token[send], several])
        digest = np.concatenate([digest[send], np.zeros(len(several), np.uint64)])
        small = np.int16 if targets < 1 << 15 else np.int32  # of the former, sorting is much faster
        yield rows((token % np.uint64(targets)).astype(small), token, digest, None)
        if len(sharing):
            sharing, counts = np.unique(sharing, return_counts=True)
            yield rows(-1 - (sharing % np.uint64(targets)).astype(np.int32), token[:0], sharing, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, digests, held = [], [], 0
        for batch in batches:
            for block in ta.blocks(batch.column(0), BLOCK_BYTES):
                token, counts = shingle_sets(block, words)
                tokens.append(token)
                digests.append(np.repeat(set_digests(token, counts)[0], counts))
                held += len(token)
                if held > HELD_TOKENS:
                    yield from dealt(tokens, digests)
                    tokens, digests, held = [], [], 0
        if held:
            yield from dealt(tokens, digests)

    return run


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _shared_counts(parts: int) -> Callable[[pa.Table], pa.Table]:
    """How many of a target's tokens each set shares with a set of another digest, packed by part."""

    def run(table: pa.Table) -> pa.Table:
        digests, own = np.unique(_joined(table, "digests", np.uint64), return_inverse=True)
        lengths = _joined(table, "lengths", np.uint32)
        if table.column("target")[0].as_py() < 0:
            counts = np.bincount(own, lengths, len(digests)).astype(np.int64)
        else:
            own = np.repeat(own, lengths)
            # Token and set as one number; a set's copies fall together.
            pair = np.unique((_joined(table, "tokens", np.uint32).astype(np.uint64) << np.uint64(32)) | own.astype(np.uint64))
            token = pair >> np.uint64(32)
            same = token[1:] == token[:-1]
            shared = np.zeros(len(pair), bool)
            shared[1:] |= same
            shared[:-1] |= same
            counts = np.bincount((pair[shared] & np.uint64(0xFFFFFFFF)).astype(np.int64), minlength=len(digests))
        some = (counts > 0) & (digests > 0)
        digests, counts = digests[some], counts[some].astype(np.uint32)
        part = (digests % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, at = np.unique(part[order], return_index=True)
        cut = lambda x: pa.array([v.tobytes() for v in np.split(x[order], at[1:])][:len(part)], pa.binary())
        return pa.table({"part": pa.array(part, pa.int32()), "digests": cut(digests), "counts": cut(counts)})

    return run


def _summed(table: pa.Table) -> pa.Table:
    """Shared tokens of each set of a part."""
    digests, own = np.unique(_joined(table, "digests", np.uint64), return_inverse=True)
    counts = np.bincount(own, _joined(table, "counts", np.uint32), len(digests)).astype(np.int64)
    return pa.table({"d1": digests.view(np.int64), "shared": counts})


def _candidate_bitmap(docs: DataFrame, keys: DataFrame, words: int, pct: int) -> np.ndarray:
    """Bits of the digests of sets of which enough tokens stand in other sets."""
    targets = max(8, 1 << (keys.count() // TARGET_DOCS).bit_length())
    blobs = docs.select("text").mapInArrow(
        _token_blobs(words, targets), "target int, tokens binary, digests binary, lengths binary")
    packed = blobs.groupBy("target").applyInArrow(_shared_counts(targets), "part int, digests binary, counts binary")
    counts = packed.groupBy("part").applyInArrow(_summed, "d1 bigint, shared bigint")
    sizes = keys.filter("n > 0").groupBy("d1").agg(F.min("n").alias("n"))
    found = stored(sizes.join(counts, "d1").filter(F.col("shared") >= _least(F.col("n"), pct)).select("d1"))
    bits = min(1 << max(16, (16 * found.count()).bit_length()), MAX_BITS)
    bit = F.col("d1").bitwiseAND(F.lit(bits - 1))
    words_of = found.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
    table = words_of.toArrow()
    bitmap = np.zeros(bits >> 6, np.uint64)
    bitmap[table.column("word").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return bitmap


def _keys(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``doc_id``, set size and digest of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in ta.blocks(batch.column(1), BLOCK_BYTES):
                tokens, counts = shingle_sets(block, words)
                d1, d2 = set_digests(tokens, counts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.last - block.first), pa.array(counts, pa.int64()),
                     pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))], ["doc_id", "n", "d1", "d2"])

    return run


def _candidate_sets(words: int, bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Digest, size and tokens of the sets whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bitmap.value
        for batch in batches:
            for block in ta.blocks(batch.column(0), BLOCK_BYTES):
                tokens, counts = shingle_sets(block, words)
                d1, d2 = set_digests(tokens, counts)
                bit = d1 & np.uint64(64 * len(held) - 1)
                keep = (held[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
                keep &= counts > 0
                chosen = np.repeat(keep, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(d1[keep].view(np.int64)), pa.array(d2[keep].view(np.int64)),
                     pa.array(counts[keep], pa.int64()),
                     ta.list_column(tokens[chosen].view(np.int64), counts[keep], pa.int64())],
                    ["d1", "d2", "n", "tokens"])

    return run


def _shared_tokens(nodes: DataFrame, pct: int) -> DataFrame:
    """Nodes that can link: ``node``, ``n``, ``tokens`` others have too, from rare to frequent.

    A token is told by 57 bits below the logarithm of its frequency.
    """
    rows = nodes.select("node", "n", F.explode("tokens").alias("token"))
    counts = stored(rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1").select(
        "token", F.floor(F.log2("df")).alias("level")))
    key = F.shiftleft("level", 57).bitwiseOR(F.shiftrightunsigned("token", 7))
    kept = rows.join(counts, "token").select("node", "n", key.alias("token"))
    listed = kept.groupBy("node", "n").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    return listed.filter(F.size("tokens") >= _least(F.col("n"), pct))


def _least(n, pct: int):
    return F.ceil(n * pct / 100)


def _linked(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Those of the pairs ``(a, b)`` whose sets are similar enough.

    Many ``a`` may have one ``b``; both joins are of stored tables, so a hot one is split.
    """
    pairs = stored(pairs)
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = stored(sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")).join(
        pairs.select("b").distinct(), "b"))
    shared = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", shared.alias("shared")).filter(
        100 * F.col("shared") >= pct * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def _leader_pairs(prefixes: DataFrame) -> DataFrame:
    """Each node with the most central node of the lists it meets most often.

    Copies of one text with changes of their own resemble it more than each other, and it has the most
    frequent tokens of them.
    """
    central = F.max(F.struct("weight", (-F.col("node")).alias("minus")))
    leaders = prefixes.groupBy("token").agg(central.alias("central")).select(
        "token", (-F.col("central.minus")).alias("leader"))
    met = join_splittable(prefixes, leaders, ["token"], "inner").filter("node <> leader")
    counts = met.groupBy("node", "leader").agg(F.count("*").alias("hits"))
    best = F.max(F.struct("hits", (-F.col("leader")).alias("minus"))).alias("best")
    return counts.groupBy("node").agg(best).select(
        F.col("node").alias("a"), (-F.col("best.minus")).alias("b"))


def _opened_pairs(prefixes: DataFrame, groups: DataFrame, pct: int) -> DataFrame:
    """Pairs of nodes of different groups that the token-group matrix doesn't rule out."""
    grouped = stored(join_splittable(prefixes, groups, ["node"]).select(
        "token", "node", "n", "rest", F.coalesce("root", "node").alias("g")))
    several = grouped.groupBy("token").agg(F.min("g").alias("lo_g"), F.max("g").alias("hi_g")).filter("lo_g < hi_g")
    rows = stored(join_splittable(grouped, several.select("token"), ["token"], "left_semi"))
    matrix = rows.groupBy("token", "g").agg(
        F.max("rest").alias("g_rest"), F.min("n").alias("g_lo"), F.max("n").alias("g_hi")).withColumnRenamed("g", "to")

    def can(rest, other_rest, n, smallest):
        return F.least(rest, other_rest) * (100 + pct) >= pct * (n + F.greatest(smallest, _least(n, pct)))

    n, rest = F.col("n"), F.col("rest")
    fits = (100 * F.col("g_hi") >= pct * n) & (pct * F.col("g_lo") <= 100 * n)
    opened = join_splittable(rows, matrix, ["token"], "inner").filter(
        (F.col("g") < F.col("to")) & fits & can(rest, F.col("g_rest"), n, F.col("g_lo")))
    members = rows.select("token", F.col("g").alias("to"), F.col("node").alias("member"),
                          F.col("n").alias("m_n"), F.col("rest").alias("m_rest"))
    pairs = join_splittable(opened, members, ["token", "to"], "inner").filter(
        (100 * F.col("m_n") >= pct * n) & (pct * F.col("m_n") <= 100 * n)
        & (F.least("rest", "m_rest") * (100 + pct) >= pct * (n + F.col("m_n"))))
    return pairs.select(F.col("node").alias("a"), F.col("member").alias("b")).distinct()


def near_duplicates(docs: DataFrame, words: int = 5, pct: int = 75) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``.

    ``component_id`` is the smallest ``doc_id`` that links lead to, the row's own included.
    """
    spark = docs.sparkSession
    keys = stored(docs.select("doc_id", "text").mapInArrow(
        _keys(words), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, d1 bigint, d2 bigint"))
    bitmap = spark.sparkContext.broadcast(_candidate_bitmap(docs, keys, words, pct))
    sets = docs.select("text").mapInArrow(
        _candidate_sets(words, bitmap), "d1 bigint, d2 bigint, n bigint, tokens array<bigint>")
    nodes = stored(sets.groupBy("d1", "d2").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
                   .withColumn("node", F.monotonically_increasing_id()))
    shared = stored(_shared_tokens(nodes, pct))
    prefix = F.slice("tokens", 1, (F.size("tokens") - _least(F.col("n"), pct) + 1).cast("int"))
    weight = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, t: a + F.shiftright(t, 57)) / F.col("n")
    prefixes = shared.select("node", "n", F.size("tokens").alias("size"), weight.alias("weight"), prefix.alias("prefix")).select(
        "node", "n", "weight", "size", F.posexplode("prefix").alias("at", "token")).select(
        "node", "n", "token", "weight", (F.col("size") - F.col("at")).alias("rest"))

    links = stored(_linked(_leader_pairs(prefixes), shared, pct))
    groups = components(links)
    more = stored(_linked(_opened_pairs(prefixes, groups, pct), shared, pct))
    roots = components(links.union(more))

    classes = keys.filter("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("least"))
    rooted = join_splittable(nodes.select("node", "d1", "d2"), roots, ["node"], "inner")
    named = stored(join_splittable(classes, rooted, ["d1", "d2"], "inner"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component"))
    labels = join_splittable(named, smallest, ["root"], "inner").select("d1", "d2", "component")
    labelled = stored(join_splittable(classes, labels, ["d1", "d2"]).select(
        "d1", "d2", F.coalesce("component", "least").alias("component")))
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return join_splittable(keys, labelled, ["d1", "d2"]).select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_per_group(docs: DataFrame, words: int = 5, pct: int = 75) -> DataFrame:
    """The rows of ``docs``, with all columns, of which ``near_duplicates`` names the component.

    Rows without words stay, and so do all rows with the ``doc_id`` of one that stays.
    """
    found = near_duplicates(docs, words, pct)
    stays = stored(found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct())
    named = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"))
    kept = named.alias("l").join(stays.alias("r"), F.col("l.id").eqNullSafe(F.col("r.doc_id")), "left_semi")
    return kept.select("doc.*")
