r"""Conversation structure repair by a rank-convergence parallel Viterbi.

The turns of a conversation are brought to role initials ``(s?(ua)+)?`` with the
cheapest edits: Keep, Rerole to user or assistant (3), Delete (4, required for
blank and repeated turns), Insert an empty user or assistant turn (3); a
truncated turn that is not deleted costs 3 more. Costs to go are kept for four
states: nothing yet, after the system turn, after a user, after an assistant.

Conversations are range-partitioned by id and turn, so one that holds a third of
all rows lies in many partitions, and cut into chunks of at most ``CHUNK_ROWS``
turns. What lies whole in one chunk inside a partition is solved where it is
read. The chunks of the others are solved in parallel:

1. Every chunk runs backwards from speculative cost vectors, one per state it
   may end in. Where these have become equal but for constants, the chunk has
   converged and says the same whatever follows.
2. The vectors of the chunks, 16 numbers each, are stitched from the last to the
   first in one sorted stream; that gives each chunk its true costs at its end.
3. A fix-up pass runs each chunk again from these and stops as soon as its
   vectors differ from the speculative ones by a constant only. The least audit
   is traced forward from each state the chunk may be entered in.
4. The states at the ends are stitched from first to last, each chunk hands out
   its part of audit and text, and the parts are put together in order.

No step holds more than a chunk, but for the audit of a conversation, which is a
value of one row. The digest of a repaired text is sequential by definition: it
is a stream over its parts in one task, with one row per chunk.

Repeated turns across chunks are found by 128-bit digests of role and text: the
smallest chunk of each digest is grouped over all chunks with partial results,
after each chunk has kept one of its own.

Nulls and special rows: a null role or text is one space (so such a turn is
blank, or has a role that no initial allows); a null turn comes first and counts
neither for gaps nor in the key of the damage, where it is one space; a null
conv_id is a conversation of its own and stays null. Turns with one number are
ordered by role and then by a digest of the text; equal rows are repeats of each
other. Blank counts before duplicate before truncated. A very long text is in a
chunk with few others. Without rows there is no result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alleleframe.llm.common import shuffle_width, staged, table

#: Turns, and characters of text, of a chunk.
CHUNK_ROWS = 4096
CHUNK_CHARS = 1 << 22
#: Turns per partition when they are put in order.
PER_TASK = 1 << 20

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state an inserted or rerolled turn leads to.
TURNED = (USER, USER, ASSISTANT, USER)
#: Costs at the end: a conversation may end empty or after an assistant; else turns are inserted.
FINAL = (0, 6, 3, 0)
RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: True cost vectors never differ by more than 10 between states: two inserted turns lead from any
#: state to an assistant, and an assistant does at most a deletion or an insertion worse than any.
FAR = 64
_WORD = re.compile(r"[^\x20\x09-\x0D]")
_LEGAL = {"su", "ua", "au"}


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the planted damage, which hangs on id and turn alone."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = conversations.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), fate.alias("fate"))
    text = F.when(F.col("fate") == 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("fate != 0").select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time")
    ).drop("_time")


# One conversation or chunk. A turn is (initial, must_go, truncated).


def _kept(initial: str, state: int) -> int:
    """The state after a kept turn, or -1."""
    if initial == "u":
        return USER if state != USER else -1
    if initial == "a":
        return ASSISTANT if state == USER else -1
    return SYSTEM if initial == "s" and state == START else -1


def step_back(after: tuple, turn: tuple) -> tuple:
    """Costs to go before a turn, from those after it; turns may be inserted before it."""
    initial, must_go, truncated = turn
    least = [DELETE + c for c in after]
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for state in range(4):
            found = RETAG + extra + after[TURNED[state]]
            to = _kept(initial, state)
            if to >= 0:
                found = min(found, extra + after[to])
            if found < least[state]:
                least[state] = found
    user = min(least[USER], INSERT + least[ASSISTANT])
    assistant = min(least[ASSISTANT], INSERT + least[USER])
    return min(least[START], INSERT + user), min(least[SYSTEM], INSERT + user), user, assistant


def costs_to_go(turns: list, after: tuple) -> list[tuple]:
    """Cost vectors before every turn and after the last one."""
    found = [after]
    for turn in reversed(turns):
        found.append(step_back(found[-1], turn))
    return found[::-1]


def parallel(a: tuple, b: tuple) -> bool:
    """Whether two cost vectors differ by a constant only."""
    gap = a[0] - b[0]
    return all(x - y == gap for x, y in zip(a, b, strict=True))


def speculative(turns: list) -> list[tuple]:
    """Cost vectors before the first turn, one per state that the chunk may end in."""
    vectors = [tuple(0 if s == end else FAR for s in range(4)) for end in range(4)]
    shared = None
    for turn in reversed(turns):
        if shared is None:
            vectors = [step_back(v, turn) for v in vectors]
            if all(parallel(v, vectors[0]) for v in vectors):
                shared = [v[0] - vectors[0][0] for v in vectors]
        else:
            vectors[0] = step_back(vectors[0], turn)
    if shared is not None:
        vectors = [tuple(c + gap for c in vectors[0]) for gap in shared]
    return vectors


def stitched(vectors: list[tuple], after: tuple) -> tuple:
    """Costs before a chunk from those after it, less their smallest."""
    found = [min(v[s] + cost for v, cost in zip(vectors, after, strict=True)) for s in range(4)]
    return tuple(c - min(found) for c in found)


def fixed_up(turns: list, after: tuple) -> list[tuple]:
    """True cost vectors of a chunk but for constants: a speculative run, rerun from its end until parallel."""
    costs = costs_to_go(turns, FINAL)
    if not parallel(after, FINAL):
        costs[-1] = after
        for i in range(len(turns) - 1, -1, -1):
            again = step_back(costs[i + 1], turns[i])
            if parallel(again, costs[i]):
                gap = again[0] - costs[i][0]
                for j in range(i + 1):
                    costs[j] = tuple(c + gap for c in costs[j])
                break
            costs[i] = again
    return costs


def traced(turns: list, costs: list[tuple], state: int, last: bool):
    """Edits of the least audit from ``state`` on: (edit, turn number, state after it).

    Turns inserted at the end of a chunk belong to the next one, but for the last.
    """
    i, n = 0, len(turns)
    while i < n or (last and costs[n][state] > 0):
        to = TURNED[state]
        if i == n:
            state = to
            yield "I", i, state
            continue
        initial, must_go, truncated = turns[i]
        here, after = costs[i][state], costs[i + 1]
        extra = TRUNCATED if truncated else 0
        kept = -1 if must_go else _kept(initial, state)
        if here == DELETE + after[state]:
            yield "D", i, state
            i += 1
        elif here == INSERT + costs[i][to]:
            state = to
            yield "I", i, state
        elif kept >= 0 and here == extra + after[kept]:
            state = kept
            yield "K", i, state
            i += 1
        else:
            state = to
            yield "R", i, state
            i += 1


def repaired(turns: list, roles: list, texts: list, costs: list[tuple], state: int, last: bool):
    """Audit, cost and lines of a chunk entered in ``state``."""
    audit, lines, cost = [], [], 0
    for edit, i, to in traced(turns, costs, state, last):
        audit.append(edit)
        role = "user" if to == USER else "assistant"
        if edit == "D":
            cost += DELETE
            continue
        if edit == "I":
            cost += INSERT
            lines.append(f"{role}:")
            continue
        cost += (RETAG if edit == "R" else 0) + (TRUNCATED if turns[i][2] else 0)
        lines.append(f"{roles[i] if edit == 'K' else role}:{texts[i]}")
    return "".join(audit), cost, "\n".join(lines), len(lines)


def digest_of(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{role}\0{text}".encode(), digest_size=16).digest()


def coded(roles: list, texts: list, seen: set) -> tuple[list, list[int]]:
    """Turns for the costs, and the numbers of blank, repeated and truncated ones.

    ``seen`` holds the digests of earlier turns and gets those of these.
    """
    turns, faults = [], [0, 0, 0]
    for role, text in zip(roles, texts, strict=True):
        digest = digest_of(role, text)
        blank, again = _WORD.search(text) is None, digest in seen
        seen.add(digest)
        truncated = not blank and text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")[-1] not in ".!?"
        for k, fault in enumerate((blank, again, truncated)):
            if fault:
                faults[k] += 1
                break
        turns.append((role[:1], blank or again, truncated))
    return turns, faults


def shape_of(turns: list, numbers: list) -> list:
    """Illegal neighbours, first and last initial, first and last turn number, number of different ones."""
    initials = [t[0] for t in turns]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False))
    known = [n for n in numbers if n is not None]
    ends = [known[0], known[-1], len(set(known))] if known else [None, None, 0]
    return [illegal, initials[0], initials[-1], *ends]


RESULT = [
    *(T.StructField(n, T.LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
    T.StructField("audit", T.StringType()),
    T.StructField("repaired_sha256", T.StringType()),
]


def solved(roles: list, texts: list, numbers: list) -> list:
    """The values of ``RESULT`` of a whole conversation."""
    turns, faults = coded(roles, texts, set())
    illegal, _, _, first, last, different = shape_of(turns, numbers)
    audit, cost, text, _ = repaired(turns, roles, texts, costs_to_go(turns, FINAL), START, True)
    gaps = 0 if first is None else last - first + 1 - different
    return [gaps, *faults, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()]


# Chunks of all conversations.


def _batch(schema: T.StructType, rows: list):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
    )


def _records(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def chunks(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Results of conversations that lie whole in a chunk, and the chunks of all others, in order of ``at``."""
    kind = turns.schema["conv_id"].dataType
    schema = T.StructType(
        [
            T.StructField("conv_id", kind),
            T.StructField("at", T.LongType()),
            T.StructField("roles", T.ArrayType(T.StringType())),
            T.StructField("texts", T.ArrayType(T.StringType())),
            T.StructField("numbers", T.ArrayType(T.LongType())),
            *RESULT,
        ]
    )

    def read(batches):
        task, made, out = TaskContext.get().partitionId(), 0, []
        conv, started, first, pieces = None, False, True, 0
        part, size = ([], [], []), 0

        def closed(whole: bool):
            nonlocal made, part, size
            made += 1
            done, part, size = part, ([], [], []), 0
            head = (conv, task << 32 | made)
            return (*head, None, None, None, *solved(*done)) if whole else (*head, *done, *[None] * len(RESULT))

        for of, turn, role, text in _records(batches):
            if not started or of != conv:
                if started:
                    # The first and the last conversation of a partition may go on in another one.
                    out.append(closed(pieces == 0 and not first))
                    first = False
                conv, started, pieces = of, True, 0
            elif len(part[0]) >= chunk_rows or size + len(text) > CHUNK_CHARS:
                out.append(closed(False))
                pieces += 1
            for column, value in zip(part, (role, text, turn), strict=True):
                column.append(value)
            size += len(text)
            if len(out) >= 256:
                yield _batch(schema, out)
                out = []
        if started:
            out.append(closed(False))
        yield _batch(schema, out)

    return turns.mapInArrow(read, schema)


def _streamed(df: DataFrame, work, schema: T.StructType) -> DataFrame:
    """What ``work`` makes of the rows of each task, one after another."""

    def read(batches):
        out = []
        for row in work(_records(batches)):
            out.append(row)
            if len(out) >= 256:
                yield _batch(schema, out)
                out = []
        yield _batch(schema, out)

    return df.mapInArrow(read, schema)


_INITIALS = "sua"


def _pack(turns: list) -> bytes:
    return bytes((_INITIALS.find(i) if i else -1) + 1 + 4 * must_go + 8 * cut for i, must_go, cut in turns)


def _unpack(data: bytes) -> list:
    return [("?sua"[c & 3], bool(c & 4), bool(c & 8)) for c in data]


def _first_digests(parts: DataFrame) -> DataFrame:
    """at, seen: the digests in a chunk that an earlier chunk of the conversation has."""
    schema = T.StructType([*parts.select("conv_id", "at").schema, T.StructField("digest", T.BinaryType())])

    def digests(rows):
        for conv, at, roles, texts in rows:
            for digest in dict.fromkeys(map(digest_of, roles, texts)):
                yield conv, at, digest

    found = staged(_streamed(parts.select("conv_id", "at", "roles", "texts"), digests, schema), "repair-digests")
    first = found.groupBy(F.col("conv_id").alias("of"), F.col("digest").alias("same")).agg(
        F.min("at").alias("first"), F.count("*").alias("n")
    )
    repeated = (F.col("digest") == F.col("same")) & F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("at") > F.col("first"))
    return found.join(first.where("n > 1"), repeated).groupBy("at").agg(F.collect_list("digest").alias("seen"))


_SHAPE = [
    *(T.StructField(n, T.LongType()) for n in ("blank", "duplicate", "truncated", "illegal")),
    *(T.StructField(n, T.StringType()) for n in ("head", "tail")),
    *(T.StructField(n, T.LongType()) for n in ("low", "high", "different")),
]


def _coded_chunks(parts: DataFrame, kind: T.StructField) -> DataFrame:
    schema = T.StructType([kind, T.StructField("at", T.LongType()), T.StructField("codes", T.BinaryType()), *_SHAPE])

    def code(rows):
        for conv, at, roles, texts, numbers, seen in rows:
            turns, faults = coded(roles, texts, set(seen or ()))
            yield conv, at, _pack(turns), *faults, *shape_of(turns, numbers)

    joined = parts.join(_first_digests(parts), "at", "left")
    return _streamed(joined.select("conv_id", "at", "roles", "texts", "numbers", "seen"), code, schema)


def _by_conversation(df: DataFrame, backwards: bool = False) -> DataFrame:
    """Rows of each conversation one after another, by ``at``."""
    order = F.desc("at") if backwards else F.asc("at")
    return df.repartition("conv_id").sortWithinPartitions("conv_id", order)


def _ends(codes: DataFrame) -> DataFrame:
    """at, after, last: the true costs at the end of every chunk."""
    schema = T.StructType([*codes.select("conv_id", "at").schema, T.StructField("vectors", T.ArrayType(T.LongType()))])

    def run(rows):
        for conv, at, data in rows:
            yield conv, at, [c for v in speculative(_unpack(data)) for c in v]

    def stitch(rows):
        conv = after = None
        for of, at, flat in rows:
            last = after is None or of != conv
            conv, after = of, FINAL if last else after
            yield at, list(after), last
            after = stitched([tuple(flat[i : i + 4]) for i in range(0, 16, 4)], after)

    vectors = _streamed(codes.select("conv_id", "at", "codes"), run, schema)
    schema = T.StructType(
        [
            T.StructField("at", T.LongType()),
            T.StructField("after", T.ArrayType(T.LongType())),
            T.StructField("last", T.BooleanType()),
        ]
    )
    return _streamed(_by_conversation(vectors, True), stitch, schema)


def _entries(codes: DataFrame, ends: DataFrame) -> DataFrame:
    """at, entry: the state in which every chunk is entered on the least audit."""
    schema = T.StructType([*codes.select("conv_id", "at").schema, T.StructField("exits", T.ArrayType(T.LongType()))])

    def run(rows):
        for conv, at, data, after, last in rows:
            turns = _unpack(data)
            costs = fixed_up(turns, tuple(after))
            exits = []
            for state in range(4):
                to = state
                for _, _, to in traced(turns, costs, state, last):
                    pass
                exits.append(to)
            yield conv, at, exits

    def stitch(rows):
        conv = state = None
        for of, at, exits in rows:
            if state is None or of != conv:
                conv, state = of, START
            yield at, state
            state = exits[state]

    exits = _streamed(codes.join(ends, "at").select("conv_id", "at", "codes", "after", "last"), run, schema)
    schema = T.StructType([T.StructField("at", T.LongType()), T.StructField("entry", T.LongType())])
    return _streamed(_by_conversation(exits), stitch, schema)


def _in_parallel(parts: DataFrame, kind: T.StructField) -> DataFrame:
    """conv_id and ``RESULT`` of conversations in several chunks."""
    codes = staged(_coded_chunks(parts, kind), "repair-codes")
    ends = staged(_ends(codes), "repair-ends")
    entries = _entries(codes, ends)
    schema = T.StructType(
        [
            kind,
            T.StructField("at", T.LongType()),
            T.StructField("audit", T.StringType()),
            T.StructField("cost", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lines", T.LongType()),
            *_SHAPE,
        ]
    )

    def mend(rows):
        for conv, at, roles, texts, data, after, last, entry, *shape in rows:
            turns = _unpack(data)
            audit, cost, text, lines = repaired(turns, roles, texts, fixed_up(turns, tuple(after)), entry, last)
            yield conv, at, audit, cost, text, lines, *shape

    names = [f.name for f in _SHAPE]
    joined = parts.drop("numbers").join(codes.drop("conv_id"), "at").join(ends, "at").join(entries, "at")
    mended = _streamed(joined.select("conv_id", "at", "roles", "texts", "codes", "after", "last", "entry", *names), mend, schema)

    def assemble(rows):
        for conv, some in groupby(rows, key=lambda r: r[0]):
            audits, cost, text, began = [], 0, hashlib.sha256(), False
            faults, illegal, tail, low, high, different = [0, 0, 0], 0, None, None, None, 0
            for _, _, audit, more, piece, lines, *shape in some:
                audits.append(audit)
                cost += more
                if lines:
                    text.update((("\n" if began else "") + piece).encode())
                    began = True
                faults = [a + b for a, b in zip(faults, shape[:3], strict=True)]
                illegal += shape[3] + (tail is not None and tail + shape[4] not in _LEGAL)
                tail = shape[5]
                if shape[6] is not None:
                    different += shape[8] - (high == shape[6])
                    low, high = shape[6] if low is None else low, shape[7]
            gaps = 0 if low is None else high - low + 1 - different
            yield conv, gaps, *faults, illegal, cost, "".join(audits), text.hexdigest()

    return _streamed(_by_conversation(mended), assemble, T.StructType([kind, *RESULT]))


def ordered_turns(turns: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """conv_id, turn, role, text in range partitions by conversation and turn, sorted; equal rows spread."""
    turn = F.col("turn").cast("long").alias("turn")
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = staged(turns.select("conv_id", turn, plain("role"), plain("text")), "repair-turns")
    rows = rows.select("*", F.md5("text").alias("_text"), F.monotonically_increasing_id().alias("_place"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "_text", "_place"]
    n_tasks = n_tasks or shuffle_width(turns.sparkSession, rows.count(), PER_TASK)
    return rows.repartitionByRange(n_tasks, *order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text")


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, n_tasks: int | None = None) -> DataFrame:
    """conv_id and the values of ``RESULT``, one row per conversation with turns."""
    found = staged(chunks(ordered_turns(turns, n_tasks), chunk_rows), "repair-chunks")
    whole = found.where("roles IS NULL").select("conv_id", *(f.name for f in RESULT))
    parts = found.where("roles IS NOT NULL").select("conv_id", "at", "roles", "texts", "numbers")
    return whole.unionByName(_in_parallel(parts, turns.schema["conv_id"]))


def with_all(conversations: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with a row for every conv_id of ``conversations``; those without turns have nothing to count."""
    ids = conversations.select(F.col("conv_id").alias("of")).distinct()
    joined = ids.join(found, F.col("of").eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    values = [
        F.coalesce(F.col(f.name), F.lit(empty.get(f.name, 0)).cast(f.dataType)).alias(f.name) for f in RESULT
    ]
    return joined.select(F.col("of").alias("conv_id"), *values)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return with_all(conversations, repair(damaged(conversations)))


SQL = {
    # The checksum comes from its bitwise definition; costs and audits go forward, one turn a step,
    # with the least (cost, audit) per state.
    "op12_conversation_repair": r"""
WITH RECURSIVE bits AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(
  list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1
  THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))),
keyed AS (SELECT conv_id, turn, COALESCE(role, ' ') AS role, COALESCE(text, ' ') AS text,
  list_transform(string_split(concat(COALESCE(CAST(conv_id AS VARCHAR), ' '), ':',
   COALESCE(CAST(turn AS VARCHAR), ' ')), ''), lambda c: ascii(c)::BIGINT) AS codes FROM conversations),
fated AS (SELECT keyed.*, xor(list_reduce(list_concat([4294967295::BIGINT], codes),
  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fate FROM keyed, bits),
damaged AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fated, range(2) AS times(k) WHERE fate <> 0 AND (k = 0 OR fate = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM damaged),
seen AS (SELECT *, bare = '' AS is_blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
  substr(role, 1, 1) AS head, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
turns AS (SELECT *, is_blank OR again AS must_go, NOT is_blank AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut
  FROM seen),
inserted(p, q, c, e, x) AS (VALUES ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
  ('', 'u', 3, 'I', 'user:'), ('s', 'u', 3, 'I', 'user:'), ('a', 'u', 3, 'I', 'user:'), ('u', 'a', 3, 'I', 'assistant:'),
  ('', 'a', 6, 'II', 'user:' || chr(10) || 'assistant:'), ('s', 'a', 6, 'II', 'user:' || chr(10) || 'assistant:')),
follows(p, q) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')),
edits AS (SELECT conv_id, i, p, p AS q, 4 AS c, 'D' AS e, '' AS x FROM turns, (SELECT DISTINCT p FROM inserted)
  UNION ALL SELECT conv_id, i, p, q, CASE WHEN cut THEN 3 ELSE 0 END, 'K', concat(role, ':', text)
   FROM turns JOIN follows ON head = q WHERE NOT must_go
  UNION ALL SELECT conv_id, i, p, q, CASE WHEN cut THEN 6 ELSE 3 END, 'R',
   concat(CASE q WHEN 'u' THEN 'user:' ELSE 'assistant:' END, text) FROM turns, follows WHERE NOT must_go AND q <> 's'),
moves AS (SELECT n.p AS p, e.q, e.conv_id, e.i, n.c + e.c AS c, n.e || e.e AS e,
  n.x || CASE WHEN n.x <> '' AND e.x <> '' THEN chr(10) ELSE '' END || e.x AS x FROM inserted n JOIN edits e ON n.q = e.p),
steps AS (SELECT conv_id, 0::BIGINT AS i, '' AS state, {'c': 0, 'e': '', 'x': ''} AS best FROM (SELECT DISTINCT conv_id FROM turns)
  UNION ALL SELECT s.conv_id, m.i, m.q, min({'c': s.best.c + m.c, 'e': s.best.e || m.e,
   'x': s.best.x || CASE WHEN s.best.x <> '' AND m.x <> '' THEN chr(10) ELSE '' END || m.x})
  FROM steps s JOIN moves m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i + 1 AND m.p = s.state
  GROUP BY s.conv_id, m.i, m.q),
ended AS (SELECT s.conv_id, min({'c': s.best.c + n.c, 'e': s.best.e || n.e,
   'x': s.best.x || CASE WHEN s.best.x <> '' AND n.x <> '' THEN chr(10) ELSE '' END || n.x}) AS best
  FROM steps s JOIN (SELECT conv_id, MAX(i) AS n FROM turns GROUP BY conv_id) l
   ON l.conv_id IS NOT DISTINCT FROM s.conv_id AND l.n = s.i
  JOIN inserted n ON n.p = s.state AND n.q IN ('', 'a') GROUP BY s.conv_id),
counts AS (SELECT conv_id, COALESCE(MAX(turn) - MIN(turn) + 1 - COUNT(DISTINCT turn), 0) AS gaps,
  COUNT(*) FILTER (is_blank) AS blank, COUNT(*) FILTER (again AND NOT is_blank) AS duplicate,
  COUNT(*) FILTER (cut) AS truncated, COUNT(*) FILTER (i > 1 AND before || head NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id)
SELECT o.conv_id, COALESCE(gaps, 0)::BIGINT AS gaps, COALESCE(blank, 0) AS blank, COALESCE(duplicate, 0) AS duplicate,
 COALESCE(truncated, 0) AS truncated, COALESCE(illegal, 0) AS illegal, COALESCE(best.c, 0)::BIGINT AS cost,
 COALESCE(best.e, '') AS audit, sha256(COALESCE(best.x, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
""",
}
