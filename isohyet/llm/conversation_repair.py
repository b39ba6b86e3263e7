"""Repair of conversations whose turns are missing, blank, repeated or out of order.

Rows are reduced to one letter each (role initial and first fault); words of letters are
parsed by `repair_grammar` in chunks of turn numbers, and the cells of a
conversation's chunks are combined the same way. Only then are the texts
shuffled, once, and streamed past the chosen edits.

A conversation may hold any share of the rows: equal rows are folded with counts,
its letters are parsed in many tasks, and its texts are read as a sorted
stream, in one task since a hash of their concatenation needs their order, but never
held. What one task holds of a conversation is one byte per row and symbol.

Defined cases: a null conv_id is a conversation of its own; null role and text are one
space, in the damage key a null id or turn too; rows of one turn are ordered by role
and the digest of the text; a role that starts with none of s, u, a (an empty one too)
can't be kept. No rows: no conversations. Other columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isohyet.llm import repair_grammar as grammar
from isohyet.llm.texts import arrow_schema

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
# Turn numbers of one parsed chunk.
CHUNK_TURNS = 256
ORDER = ("turn", "role", "digest")
ROW_BATCH = 10_000


def standard_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies (1): nulls of role and text become one space."""
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), F.lit(1).cast("long").alias("copies"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows as `standard_rows`, one in twenty each dropped (0 copies), emptied, stripped of its ends, doubled or given to the user."""
    rows = standard_rows(conversations)
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("_kind", F.crc32(key) % 20)
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("copies"))


def _chunk() -> Column:
    return F.floor(F.col("turn") / CHUNK_TURNS).cast("long").alias("chunk")


def _lettered(rows: DataFrame) -> DataFrame:
    """Equal rows as one, with the letter of the first copy and that of the others."""
    body = F.rtrim("text", F.lit(SPACES))
    folded = rows.select(
        "conv_id", "turn", "role", F.md5("text").alias("digest"), (body == "").alias("blank"),
        (~F.substring(body, -1, 1).isin(*ENDS)).alias("truncated"), "copies",
    ).groupBy("conv_id", "turn", "role", "digest").agg(
        F.first("blank").alias("blank"), F.first("truncated").alias("truncated"), F.sum("copies").alias("copies"))
    # The first turn with a role and text; found by minima, so a text repeated in very many turns is combined before the shuffle.
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    first = folded.filter("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first")).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), F.col("first.turn").alias("_turn"))
    marked = folded.join(
        first, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("turn").eqNullSafe(F.col("_turn"))
        & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")), "left")
    initial = F.substring("role", 1, 1)
    of = {f: F.element_at(F.create_map(*[x for i in grammar.INITIALS for x in (F.lit(i), F.lit(grammar.letter(i, f)))]),
                          F.when(initial.isin("s", "u", "a"), initial).otherwise("x")) for f in grammar.FAULTS}
    again = F.when(F.col("blank"), of["blank"]).otherwise(of["duplicate"])
    once = F.when(F.col("blank"), of["blank"]).when(F.col("_role").isNull(), of["duplicate"]).when(
        F.col("truncated"), of["truncated"]).otherwise(of["none"])
    return marked.select("conv_id", _chunk(), *ORDER, once.alias("letter"), again.alias("again"), "copies")


def _chunk_fields(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", id_type)]).add("chunk", "long").add("rows", "long").add(
        "faults", T.ArrayType(T.LongType())).add("illegal", "long").add("first", "string").add("last", "string").add(
        "low", "long").add("high", "long").add("turns", "long").add("costs", T.ArrayType(T.LongType())).add(
        "audits", T.ArrayType(T.StringType()))


def _batches(rows: Iterator[list], schema: pa.Schema, size: int = ROW_BATCH) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most `size` rows or about 8 MB of strings."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or weight > 8_000_000:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with equal first `width` values, as streams: rows arrive sorted."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    return groupby(rows, key=lambda row: row[:width])


def is_illegal(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def parse_chunk(word: str, parser: grammar.Parser) -> list:
    """Counts and cell of one word of letters."""
    initials = [grammar.initial_of(c) for c in word]
    faults = [sum(word.count(grammar.letter(i, f)) for i in grammar.INITIALS) for f in grammar.FAULTS[1:]]
    cell = parser.cell(word)
    values = [cell.get(pair) for pair in grammar.PAIRS]
    return [len(word), faults, sum(map(is_illegal, initials, initials[1:])), *(initials[:1] or [None]), *(initials[-1:] or [None]),
            [v and v[0] for v in values], [v and v[1] for v in values]]


def _cells_of_chunks(lettered: DataFrame) -> DataFrame:
    fields = _chunk_fields(lettered.schema["conv_id"].dataType)
    schema = arrow_schema(fields)

    def rows(batches):
        parser = grammar.Parser()
        for (conv, chunk), group in _groups(batches, 2):
            word, low, high, turns = [], None, None, 0
            for _, _, turn, _, _, letter, again, copies in group:
                if not copies:
                    continue
                word.append(letter + again * (copies - 1))
                if turn is not None and turn != high:
                    low, high, turns = (turn if low is None else low), turn, turns + 1
            n, faults, illegal, first, last, costs, audits = parse_chunk("".join(word), parser)
            yield [conv, chunk, n, faults, illegal, first, last, low, high, turns, costs, audits]

    ordered = lettered.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", *ORDER)
    return ordered.mapInArrow(lambda batches: _batches(rows(batches), schema, 500), fields)


STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _piece_fields(id_type: T.DataType) -> T.StructType:
    fields = T.StructType([T.StructField("conv_id", id_type)]).add("chunk", "long").add("edits", "string")
    for name in STATS:
        fields = fields.add(name, "string" if name == "audit" else "long")
    return fields


def pieces_of(audit: str, sizes: list[int]) -> list[str]:
    """The audit cut after each so many edits of rows; insertions stay with the row that follows, the last ones with the last piece."""
    out, at = [], 0
    for size in sizes:
        low = at
        while size:
            size -= audit[at] != grammar.INSERT
            at += 1
        out.append(audit[low:at])
    if out:
        out[-1] += audit[at:]
    return out


def _edits(chunks: DataFrame) -> DataFrame:
    """conv_id, chunk, its edits; the numbers of the conversation stand at its first chunk."""
    fields = _piece_fields(chunks.schema["conv_id"].dataType)
    schema = arrow_schema(fields)

    def rows(batches):
        for _, group in _groups(batches, 1):
            group = list(group)
            cells = [{p: (c, a) for p, c, a in zip(grammar.PAIRS, g[10], g[11]) if c is not None} for g in group]
            cost, audit = grammar.best(grammar.merged(cells))
            full = [g for g in group if g[2]]
            illegal = sum(g[4] for g in full) + sum(is_illegal(a[6], b[5]) for a, b in zip(full, full[1:]))
            known = [g for g in full if g[9]]
            gaps = max(g[8] for g in known) - min(g[7] for g in known) + 1 - sum(g[9] for g in known) if known else 0
            blank, duplicate, truncated = (sum(g[3][i] for g in full) for i in (2, 1, 0))
            stats = [gaps, blank, duplicate, truncated, illegal, cost, audit]
            for g, piece in zip(group, pieces_of(audit, [g[2] for g in group])):
                yield [g[0], g[1], piece, *stats]
                stats = [None] * len(STATS)

    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return ordered.mapInArrow(lambda batches: _batches(rows(batches), schema, 2000), fields)


def _stream(rows: DataFrame) -> DataFrame:
    """Rows behind the edits of their chunks, each conversation in order in one partition."""
    edits = _edits(_cells_of_chunks(_lettered(rows)))
    none = F.lit(None)
    texts = rows.filter("copies > 0").select(
        "conv_id", _chunk(), F.lit(1).alias("kind"), "turn", "role", F.md5("text").alias("digest"), "text", "copies",
        none.cast("string").alias("edits"), *[none.cast("string" if n == "audit" else "long").alias(n) for n in STATS])
    heads = edits.select(
        "conv_id", "chunk", F.lit(0).alias("kind"), none.cast("long").alias("turn"), *[none.cast("string").alias(n) for n in ("role", "digest", "text")],
        F.lit(0).cast("long").alias("copies"), "edits", *STATS)
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "kind", *ORDER)


def repaired_rows(group: Iterator[tuple]) -> Iterator[tuple]:
    """Replays edits over a conversation's stream: ('stats', values) once, then ('row', role, text) per repaired row."""
    edits, at, state = "", 0, grammar.START

    def inserted():
        nonlocal at, state
        while at < len(edits) and edits[at] == grammar.INSERT:
            role = grammar.next_role(state)
            at, state = at + 1, grammar.STEPS[state, role[0]]
            yield "row", role, ""

    for row in group:
        if row[2] == 0:
            yield from inserted()
            edits, at = row[8], 0
            if row[9] is not None:
                yield "stats", row[9:]
            continue
        for _ in range(row[7]):
            yield from inserted()
            edit, at = edits[at], at + 1
            if edit == grammar.DELETE:
                continue
            role = row[4] if edit == grammar.KEEP else grammar.next_role(state)
            state = grammar.STEPS[state, role[0]]
            yield "row", role, row[6]
    yield from inserted()


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of `rows` (as `standard_rows` or `damaged` return them): the numbers, the audit and the hash of the repaired rows.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    A conversation of which no row is left has zeros, an empty audit and the hash of nothing.
    """
    fields = T.StructType([rows.schema["conv_id"]])
    for name in STATS:
        fields = fields.add(name, "string" if name == "audit" else "long")
    fields = fields.add("repaired_sha256", "string")
    schema = arrow_schema(fields)

    def numbers(batches):
        for (conv,), group in _groups(batches, 1):
            stats, digest, between = None, hashlib.sha256(), b""
            for kind, *values in repaired_rows(group):
                if kind == "stats":
                    stats = values[0]
                else:
                    digest.update(between + f"{values[0]}:{values[1]}".encode())
                    between = b"\n"
            yield [conv, *stats, digest.hexdigest()]

    return _stream(rows).mapInArrow(lambda batches: _batches(numbers(batches), schema), fields)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text."""
    fields = T.StructType([rows.schema["conv_id"]]).add("position", "long").add("role", "string").add("text", "string")
    schema = arrow_schema(fields)

    def turns(batches):
        for (conv,), group in _groups(batches, 1):
            kept = (values for kind, *values in repaired_rows(group) if kind == "row")
            for i, (role, text) in enumerate(kept):
                yield [conv, i, role, text]

    return _stream(rows).mapInArrow(lambda batches: _batches(turns(batches), schema), fields)
