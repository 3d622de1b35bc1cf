"""Cheapest repair of conversations by dynamic programming over a grammar.

A conversation is the sequence of its rows by turn (nulls first), then role, then text. Each row is one
symbol: its role's initial and its first fault. Rows are cut into chunks of at most ``CHUNK`` symbols;
Re-Pair, counting over the chunks of all conversations, replaces the most frequent pairs of neighbours by
new symbols, round by round. Each symbol has one min-plus matrix over the four states of the
grammar of good conversations; an entry is the least cost of an edit from state to state and
its audit, a rope that shares the ropes of the symbol's two halves. A conversation is one vector taken
through the matrices of its compressed chunks, in order.

Good conversations are ``(s?(ua)+)?`` in initials of roles. Keep costs 0; Rerole to user or assistant and
Insert of an empty row of either, anywhere, cost 3; Delete costs 4; a truncated row that isn't deleted adds 3.
Blank and duplicate rows have to be deleted. Of equally cheap audits the ASCII-least counts. An audit
is a sum of its letters' costs, so no two equally cheap ones of the same rows are prefixes of each other, and
the least of two halves makes the least whole.

Nulls in ``role`` and ``text`` count as one space, a null ``turn`` comes first, and rows with a null
``conv_id`` are a conversation of their own. Texts are hashed whole. Rows that repeat are duplicates; of rows
of one turn the order is by role, then text. An empty table gives no rows, and other columns, whatever
their names, are left alone. A conversation without rows has cost 0 and an empty audit.

What one task holds: a chunk, the rules (at most ``MAX_RULES``), and of a conversation its chunks' ropes and its
audit, a letter a row. The hash of a repaired conversation is one chain over its text, so one
task reads a conversation's rows, in order and without holding them.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from saldoflow.operators.joins import join_splittable
from saldoflow.sources.storage import stored

#: Symbols of a chunk, new rules of a round, and rules at most (the rest of the work is done without rules).
CHUNK, ROUND_RULES, MAX_RULES = 512, 512, 4096
LEAF = 32  # texts of a rope up to this length are one piece
WHITE = " \t\n\x0b\x0c\r"
RULES_FROM = 0xE000  # private code points name the rules

# States: nothing yet, after the system row, after a user row, after an assistant row.
STATES, START, ACCEPTED = 4, 0, (0, 3)
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
RELABEL, INSERT, DELETE, TRUNCATED = 3, 3, 4, 3

#: A rope is a text, or (length, left, right); an entry is (cost, rope); a matrix maps (from, to) to entries.
Rope = str | tuple
Matrix = dict[tuple[int, int], tuple[int, Rope]]


def _size(rope: Rope) -> int:
    return len(rope) if isinstance(rope, str) else rope[0]


def joined(a: Rope, b: Rope) -> Rope:
    if a == "" or b == "":
        return b or a
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= LEAF:
        return a + b
    return (_size(a) + _size(b), a, b)


def flat(rope: Rope) -> str:
    found, left = [], [rope]
    while left:
        top = left.pop()
        if isinstance(top, str):
            found.append(top)
        else:
            left += [top[2], top[1]]
    return "".join(found)


def before(a: Rope, b: Rope) -> bool:
    """Whether ``a`` is the smaller text; parts that both share are passed without being read."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        if isinstance(p, str) and isinstance(q, str):
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p[:n] < q[:n]
            x += [p[n:]] if p[n:] else []
            y += [q[n:]] if q[n:] else []
            continue
        # The longer one is opened, so that equal parts come to lie against each other.
        if not isinstance(p, str) and (isinstance(q, str) or p[0] >= q[0]):
            x += [p[2], p[1]]
            y.append(q)
        else:
            x.append(p)
            y += [q[2], q[1]]
    return bool(y)


def better(new: tuple[int, Rope], old: tuple[int, Rope] | None) -> bool:
    return old is None or new[0] < old[0] or new[0] == old[0] and before(new[1], old[1])


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product."""
    out: Matrix = {}
    for (i, k), (cost, rope) in a.items():
        for j in range(STATES):
            if (k, j) in b:
                more, rest = b[k, j]
                if better(entry := (cost + more, joined(rope, rest)), out.get((i, j))):
                    out[i, j] = entry
    return out


def _inserts() -> Matrix:
    """No insert, or the fewest that lead from state to state."""
    one = {(i, j): (INSERT, "I") for step in ("u", "a") for i, j in STEPS[step].items()}
    none: Matrix = {(i, i): (0, "") for i in range(STATES)}
    out = none
    for _ in range(STATES):
        more = times(out, one)
        out = out | {k: v for k, v in more.items() if better(v, out.get(k))}
    return out


INSERTS = _inserts()


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts before a row and what becomes of it. ``x`` has to go; a capital is a truncated row."""
    edits: Matrix = {(i, i): (DELETE, "D") for i in range(STATES)}
    if symbol != "x":
        cut = TRUNCATED if symbol.isupper() else 0
        for role, step in STEPS.items():
            kept = role == symbol.lower()
            for i, j in step.items():
                entry = (cut, "K") if kept else (RELABEL + cut, "R")
                if (kept or role != "s") and better(entry, edits.get((i, j))):
                    edits[i, j] = entry
    return times(INSERTS, edits)


TERMINALS = {c: symbol_matrix(c) for c in "xsSuUaAoO"}


class Grammar:
    """Rules by name, in order of their making, and the matrices of all symbols, from the bottom up."""

    def __init__(self, rules: list[str]):
        self.rules = [(pair, chr(RULES_FROM + i)) for i, pair in enumerate(rules)]
        self.matrices = dict(TERMINALS)
        for pair, name in self.rules:
            self.matrices[name] = times(self.matrices[pair[0]], self.matrices[pair[1]])

    def compressed(self, sequences: list[str], first: int = 0) -> list[str]:
        """The sequences with every pair replaced by its rule, from rule ``first`` on."""
        text = "\n".join(sequences)
        for pair, name in self.rules[first:]:
            text = text.replace(pair, name)
        return text.split("\n")

    def through(self, vector: dict[int, tuple[int, Rope]], compressed: str) -> dict[int, tuple[int, Rope]]:
        """States that a vector of states leads to."""
        at: Matrix = {(START, k): v for k, v in vector.items()}
        for symbol in compressed:
            at = times(at, self.matrices[symbol])
        return {j: v for (_, j), v in at.items()}

    @staticmethod
    def ended(vector: dict[int, tuple[int, Rope]]) -> tuple[int, str]:
        """The cheapest end: cost and audit."""
        ends = times({(START, k): v for k, v in vector.items()}, INSERTS)
        best = None
        for (_, j), v in ends.items():
            if j in ACCEPTED and better(v, best):
                best = v
        return best[0], flat(best[1])


def repaired(audit: Iterator[str], kept: int, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of each repaired row; ``kept`` is the number of letters but D. Odd numbers begin with s."""
    at = kept % 2  # the next row is a user's if even, counted without the system row
    at = -1 if at else 0
    for letter in audit:
        role = "user" if at % 2 == 0 else "assistant"
        if letter == "I":
            yield role, ""
        else:
            own, text = next(rows)
            if letter == "D":
                continue
            yield (own if letter == "K" else role), text
        at += 1


# --- on Spark ------------------------------------------------------------------------------

def _initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def _in_order(rows: DataFrame) -> DataFrame:
    """Rows in parts by range; of rows of one turn the order is by role and text."""
    keys = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def skeleton(rows: DataFrame) -> DataFrame:
    """Per row: ``conv``, ``turn``, ``pos`` (ascending within each conversation), ``initial``, ``fault``.

    A fault is ``blank``, ``duplicate``, ``truncated`` or null. No text leaves the sorted parts but as a digest.
    """
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    last = F.substring(end, -1, 1)
    own = F.when(F.length(end) == 0, "blank").when(~last.isin(".", "!", "?"), "truncated")
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    bare = stored(_in_order(rows).select(
        "conv", "turn", F.monotonically_increasing_id().alias("pos"), _initial().alias("initial"), own.alias("own"),
        said.alias("said")))
    again = bare.groupBy("conv", "said").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    seen = join_splittable(bare, again.drop("n"), ["conv", "said"], "left")
    fault = F.when((F.col("own") != "blank") | F.col("own").isNull(), F.when(F.col("pos") > F.col("first"), "duplicate"))
    return seen.select("conv", "turn", "pos", "initial", F.coalesce(fault, "own").alias("fault"))


def chunks(bare: DataFrame) -> DataFrame:
    """Per chunk: ``conv``, ``chunk`` (ascending), ``symbols``, ``initials``, and its numbers of faults."""
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
              .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))
    ordered = F.array_sort(F.collect_list(F.struct("pos", symbol.alias("symbol"), "initial")))
    counts = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
    return (bare.groupBy("conv", F.floor(F.col("pos") / CHUNK).alias("chunk")).agg(ordered.alias("rows"), *counts)
            .select("conv", "chunk", F.array_join("rows.symbol", "").alias("symbols"),
                    F.array_join("rows.initial", "").alias("initials"), "blank", "duplicate", "truncated"))


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            at = 0
            while at < len(text) - 1:
                pair = text[at:at + 2]
                counts[pair] += n
                # in a run of one symbol, pairs don't overlap
                at += 2 if pair[0] == pair[1] and text[at + 2:at + 3] == pair[0] else 1
        if len(counts) > 100_000:
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pair", "n"])
            counts.clear()
    yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pair", "n"])


def _compressing(rules: list[str], first: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(rules)
        for batch in batches:
            texts = grammar.compressed(batch.column(0).to_pylist(), first) if len(batch) else []
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], ["symbols", "n"])

    return run


def re_pair(parts: DataFrame) -> list[str]:
    """Pairs that became rules, the first ``RULES_FROM``.

    A round counts the pairs of all sequences and makes rules of the most frequent ones, in order of
    their counts; the next round counts on what they left. It ends when a round's pairs are less than a
    hundredth of the symbols, as more rules would hardly shorten anything.
    """
    sequences = stored(parts.groupBy("symbols").agg(F.count("*").alias("n")))
    rules: list[str] = []
    while len(rules) < MAX_RULES:
        found = sequences.mapInArrow(_pair_counts, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        most = found.filter("n > 1").orderBy(F.desc("n"), "pair").limit(min(ROUND_RULES, MAX_RULES - len(rules))).collect()
        symbols = sequences.agg(F.sum(F.length("symbols") * F.col("n"))).first()[0]
        if not most or 100 * sum(r.n for r in most) < symbols:
            break
        first = len(rules)
        rules += [r.pair for r in most]
        sequences = stored(sequences.mapInArrow(_compressing(rules, first), "symbols string, n bigint"))
    return rules


FOLDED = ("conv struct<conv_id:{0}>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string")
LEGAL = ("su", "ua", "au")


def _folding(rules: list[str], conv: pa.DataType) -> Callable:
    """Per conversation, from its chunks in order: numbers of faults, cost and audit."""

    def chunk_rows(batches: Iterator[pa.RecordBatch], grammar: Grammar) -> Iterator[tuple]:
        for batch in batches:
            c = [batch.column(i).to_pylist() for i in range(7)]
            yield from zip(c[0], grammar.compressed(c[2]) if len(batch) else [], *c[3:7], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, known, out = Grammar(rules), {}, []

        def flush() -> pa.RecordBatch:
            kinds = [conv, *[pa.int64()] * 5, pa.string()]
            names = ["conv", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            columns = list(zip(*out, strict=True)) or [[]] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

        for key, parts in groupby(chunk_rows(batches, grammar), key=lambda r: r[0]):
            vector, sums, last = {START: (0, "")}, [0, 0, 0, 0], ""
            for n, (_, symbols, initials, *faults) in enumerate(parts):
                if n:
                    vector = grammar.through(vector, symbols)
                else:  # most conversations are one chunk, and many are alike
                    if symbols not in known:
                        if len(known) > 50_000:
                            known.clear()
                        known[symbols] = grammar.through(vector, symbols)
                    vector = known[symbols]
                both = last + initials
                sums = [a + b for a, b in zip(sums, [*faults, sum(both[i:i + 2] not in LEGAL for i in range(len(both) - 1))], strict=True)]
                last = initials[-1:]
            out.append((key, *sums, *grammar.ended(vector)))
            if len(out) >= 10_000:
                yield flush()
        yield flush()

    return run


def _hashing(names: list[str], kinds: list[pa.DataType]) -> Callable:
    """Passes each conversation's head row on with the hash of what its rows become."""

    def flat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names)

        for _, rows in groupby(flat_rows(batches), key=lambda r: r[0]):
            head = next(rows)[2]
            digest, audit, more = hashlib.sha256(), head["audit"], False
            for role, text in repaired(iter(audit), len(audit) - audit.count("D"), ((r[4], r[5]) for r in rows)):
                digest.update((("\n" if more else "") + f"{role}:{text}").encode())
                more = True
            for _ in rows:
                pass
            out.append((*head.values(), digest.hexdigest()))
            if len(out) >= 10_000:
                yield flush()
        yield flush()

    return run


def repair(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows``, and of ``every`` (a table with ``conv_id``) if given.

    Returns ``conv_id``, ``gaps`` (turns that are missing between the first and the last), ``blank``, ``duplicate``,
    ``truncated`` (rows by their first fault), ``illegal`` (neighbours whose roles' initials aren't su, ua or
    au), ``cost``, ``audit`` (an initial per edit) and ``repaired_sha256`` (of the repaired rows).
    """
    blank = F.lit(" ")
    plain = rows.select(F.struct("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))
    bare = stored(skeleton(plain))
    parts = stored(chunks(bare))
    rules = re_pair(parts)
    kind = rows.schema["conv_id"].dataType.simpleString()
    conv = to_arrow_type(parts.schema["conv"].dataType)
    ordered = parts.repartition("conv").sortWithinPartitions("conv", "chunk")
    folded = ordered.mapInArrow(_folding(rules, conv), FOLDED.format(kind))
    spans = bare.groupBy("conv").agg(
        F.min("turn").alias("least"), F.max("turn").alias("most"), F.count_distinct("turn").alias("turns"))
    gaps = spans.select("conv", F.coalesce(F.col("most") - F.col("least") + 1 - F.col("turns"), F.lit(0)).alias("gaps"))
    known = (every if every is not None else rows).select(F.struct("conv_id").alias("conv")).distinct()
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    heads = (known.join(gaps, "conv", "left").join(folded, "conv", "left")
             .select("conv", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in numbers],
                     F.coalesce("audit", F.lit("")).alias("audit")))
    heads = stored(heads)
    head_type = heads.schema.simpleString()
    both = heads.select("conv", F.lit(0).alias("part"), F.struct("*").alias("head"), F.lit(None).cast("bigint").alias("turn"),
                        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text")).unionByName(
        plain.select("conv", F.lit(1).alias("part"), F.lit(None).cast(head_type).alias("head"), "turn", "role", "text"))
    gathered = both.repartition("conv").sortWithinPartitions("conv", "part", F.col("turn").asc_nulls_first(), "role", "text")
    names = [*heads.columns, "repaired_sha256"]
    kinds = [to_arrow_type(f.dataType) for f in heads.schema] + [pa.string()]
    done = gathered.mapInArrow(_hashing(names, kinds), ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in heads.schema) + ", repaired_sha256 string")
    return done.select("conv.conv_id", *numbers, "audit", "repaired_sha256")


def damage(rows: DataFrame) -> DataFrame:
    """Damages rows by a hash of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes its
    ``[.!?]``, 3 repeats it, 4 makes it a user's. Nulls count as one space. Returns ``conv_id, turn, role, text``."""
    blank = F.lit(" ")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key) % 20
    named = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind")).filter("kind <> 0")
    changed = named.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        "kind")
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return changed.withColumn("nth", F.explode(copies)).select("conv_id", "turn", "role", "text")
