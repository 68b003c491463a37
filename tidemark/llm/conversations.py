"""Repair of the structure of conversations by depth-first branch-and-bound.

A well-formed conversation is empty, or one or more rows of the user each answered by the
assistant, with at most one system row before them. A row is kept, given another role or
deleted, and empty rows are inserted; the cheapest edits win, of equally cheap ones those
whose initials in order come first in ASCII.

A conversation may hold a third of all rows. What the search needs of a row, one letter, is
therefore gathered in order in chunks of bounded length, over all tasks. A short conversation
is searched as it is. In a longer one every block of rows is searched from each state it can
begin in to each state it can end in, and the costs of blocks, then of chunks, are put together.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import staged

# States of what has been given out so far: nothing, the system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
# The role that comes next depends on the state alone, and is also the state it leads to.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
# What brings a state to a well-formed end.
ENDING = {START: (0, ""), SYSTEM: (10, "II"), USER: (5, "I"), ASSISTANT: (0, "")}
DELETE, REROLE, INSERT, UNFINISHED = 2, 1, 5, 5
# Letters of rows: b blank, d duplicate; the initial of the role otherwise (o: none of the three), a capital if whole, small if truncated.
MUST_GO = "bd"
# Rows of one search, and of one task's record: a longer conversation is put together from searches.
BLOCK, CHUNK = 32, 2048

CHUNKS = "conv_id long, turn long, role string, same binary, at long, letters string, counts array<long>"
REPAIRED = "conv_id long, position long, edit string, fault string, turn long, old_role string, role string, text string"


OTHER = {"U": "A", "A": "U", "": ""}


class Bounds:
    """Least costs of the rows from a place on, whatever came before.

    A row that must go costs its deletion, a truncated one that or more, and one of neither
    the user nor the assistant an edit of its own, a system row only after the start. Where a
    whole row meets its own role as the next one, edits just counted taken as made, something
    more is needed at either or between them: such pairs are counted from the end, none with a
    row of another. The first row that is in no pair may also stand against the state.
    """

    def __init__(self, letters: str, counts: list[int]):
        n = len(letters)
        self.fresh, self.later = [(0, "")] * (n + 1), [(0, "")] * (n + 1)
        for bounds, system in ((self.fresh, 0), (self.later, 1)):
            cost, ahead = 0, ""
            for i in range(n - 1, -1, -1):
                letter = letters[i]
                if letter in MUST_GO:
                    cost += DELETE * counts[i]
                elif letter.islower():
                    cost += DELETE
                elif letter == "S" and not system:
                    ahead = ""
                elif letter in "SO":
                    cost, ahead = cost + REROLE, OTHER[ahead]
                elif letter == ahead:
                    cost, ahead = cost + 1, ""
                else:
                    ahead = letter
                bounds[i] = cost, ahead

    def __call__(self, i: int, state: int) -> int:
        cost, first = (self.fresh if state == START else self.later)[i]
        return cost + (first == ("U" if state == USER else "A"))


def search(letters: str, counts: list[int], entry: int = START, target: int | None = None) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest repair, edits by their initials with one D for a run that must go.

    Without ``target`` the rows end the conversation, and what its end lacks is inserted. With
    it they must lead from ``entry`` to that state, the last edit not an insertion; none if
    they can't. The stack holds prefixes; the table, for every place and state, the best prefix
    met there. Of two prefixes at one place neither starts with the other at equal cost, as
    they took the same rows, so the lesser stays the lesser whatever follows.
    """
    n, bounds = len(letters), Bounds(letters, counts)
    table: dict[tuple[int, int], tuple[int, str]] = {(0, entry): (0, "")}
    best: tuple[int, str] | None = None
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, edits = stack.pop()
        if table[i, state] != (cost, edits):
            continue
        if best is not None:
            least = cost + bounds(i, state)
            if least > best[0] or (least == best[0] and edits > best[1][:len(edits)]):
                continue
        if i == n:
            more, end = ENDING[state] if target is None else (0, "")
            if target is None or state == target:
                found = cost + more, edits + end
                best = found if best is None else min(best, found)
            continue
        letter, coming = letters[i], NEXT[state]
        ways = [(i + 1, state, cost + (DELETE * counts[i] if letter in MUST_GO else DELETE), edits + "D")]
        if letter not in MUST_GO:
            late, role = (UNFINISHED if letter.islower() else 0), letter.upper()
            if role == ("U" if coming == USER else "A"):
                ways.append((i + 1, coming, cost + late, edits + "K"))
            else:
                ways.append((i + 1, coming, cost + late + REROLE, edits + "R"))
                if role == "S" and state == START:
                    ways.append((i + 1, SYSTEM, cost + late, edits + "K"))
            ways.append((i, coming, cost + INSERT, edits + "I"))
        good = []
        for way in ways:
            node, value = way[:2], way[2:]
            if node not in table or value < table[node]:
                table[node] = value
                good.append((way[2] + bounds(*node), way[3], way))
        stack += [way for _, _, way in sorted(good, reverse=True)]
    return best


Table = dict[tuple[int, int], tuple[int, str]]


def between(letters: str, counts: list[int]) -> Table:
    """(cost, edits) for each (entry, target) the rows can lead between."""
    return {(entry, target): way for entry in ENDING for target in ENDING
            if (way := search(letters, counts, entry, target)) is not None}


def ranked(table: Table) -> dict[tuple[int, int], tuple[int, int]]:
    """(cost, place of the edits among those of the same entry)."""
    order = {entry: sorted(edits for (e, _), (_, edits) in table.items() if e == entry) for entry in ENDING}
    return {way: (cost, order[way[0]].index(edits)) for way, (cost, edits) in table.items()}


def forward(tables: list[dict[tuple[int, int], tuple[int, int]]], entry: int = START):
    """({target: (cost, rank)}, steps back) of the cheapest chains of ranked tables, of equally cheap ones the least in ASCII.

    Prefixes of one entry that end in different states after the same rows differ before the
    shorter one ends, so their order, once known, holds whatever follows.
    """
    state, steps = {entry: (0, 0)}, []
    for table in tables:
        ways: dict[int, tuple] = {}
        for (before, target), (cost, rank) in table.items():
            if before in state:
                way = state[before][0] + cost, (state[before][1], rank), before
                ways[target] = min(ways.get(target, way), way)
        order = sorted(way[1] for way in ways.values())
        state = {target: (way[0], order.index(way[1])) for target, way in ways.items()}
        steps.append({target: way[2] for target, way in ways.items()})
    return state, steps


def back(steps: list[dict[int, int]], target: int) -> list[tuple[int, int]]:
    """The (entry, target) of every step of the chain that ends in ``target``."""
    out = []
    for step in reversed(steps):
        out.append((step[target], target))
        target = step[target]
    return out[::-1]


def last_state(state: dict[int, tuple[int, int]]) -> int:
    """Where the cheapest chain ends, what its end lacks included."""
    return min(state, key=lambda s: (state[s][0] + ENDING[s][0], state[s][1]))


def _blocks(letters: str, counts: list[int]) -> list[Table]:
    return [between(letters[i:i + BLOCK], counts[i:i + BLOCK]) for i in range(0, len(letters), BLOCK)]


def repair_letters(letters: str, counts: list[int]) -> str:
    """Edits of a whole conversation: one search, or that of its blocks put together."""
    if len(letters) <= BLOCK:
        return search(letters, counts)[1]
    tables = _blocks(letters, counts)
    state, steps = forward([ranked(t) for t in tables])
    target = last_state(state)
    return "".join(t[way][1] for t, way in zip(tables, back(steps, target), strict=True)) + ENDING[target][1]


def between_blocks(letters: str, counts: list[int]) -> Table:
    """``between`` of any number of rows, from its blocks."""
    tables = _blocks(letters, counts)
    ranks, out = [ranked(t) for t in tables], {}
    for entry in ENDING:
        state, steps = forward(ranks, entry)
        for target, (cost, _) in state.items():
            out[entry, target] = cost, "".join(t[way][1] for t, way in zip(tables, back(steps, target), strict=True))
    return out


def _conv(name: str = "conv_id") -> Column:
    """A key that is never null: a null conversation is one of its own."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def _filled(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])


def _same() -> Column:
    """Equal for rows of a conversation with the same role and text."""
    return F.unhex(F.sha2(F.concat_ws(":", _conv(), F.length("role").cast("string"), "role", "text"), 256)).alias("same")


def lettered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, same, letter, again): a row for all equal rows of a turn. ``letter`` is that of the first
    of them, none if all are duplicates or blank; ``again`` counts the others. Texts don't leave the map tasks."""
    visible = F.col("text").rlike("[^\\x20\\x09-\\x0D]")
    ended = F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    initial = F.substring("role", 1, 1)
    role = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    letter = F.when(~visible, "b").when(ended, F.upper(role)).otherwise(role)
    compact = staged(spark, rows.select("conv_id", "turn", "role", _same(), letter.alias("letter")).groupBy(
        "conv_id", "turn", "role", "same", "letter").agg(F.count("*").alias("n")), "letters")
    first = compact.groupBy("same").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("turns")).filter("turns > 1").drop("turns")
    met = compact.join(first, "same", "left").withColumn(
        "later", F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn")))
    alone = (F.col("letter") != "b") & ~F.col("later")
    return met.select("conv_id", "turn", "role", "same", F.when(alone, F.col("letter")).alias("letter"),
                      (F.col("n") - F.when(alone, 1).otherwise(0)).alias("again"),
                      F.when(F.col("letter") == "b", "b").otherwise("d").alias("more"))


def chunks(rows: DataFrame, size: int) -> DataFrame:
    """CHUNKS: letters of at most ``size`` items of one conversation in order, by its first row; ``at`` grows in that order."""
    order = ["conv_id", "turn", "role", "same"]

    def run(batches):
        from pyspark import TaskContext
        at = TaskContext.get().partitionId() << 32
        held: dict = {}
        done: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                for letter, count in ((r["letter"], 1), (r["more"], r["again"])):
                    if letter is None or not count:
                        continue
                    if held and (held["conv_id"] != r["conv_id"] or len(held["letters"]) == size):
                        done.append(held)
                        held = {}
                    if not held:
                        held = {k: r[k] for k in order} | {"at": at, "letters": "", "counts": []}
                        at += 1
                    held["letters"] += letter
                    held["counts"].append(count)
            if done:
                yield _batch(done, CHUNK_TYPE)
                done = []
        if held:
            yield _batch([held], CHUNK_TYPE)

    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, CHUNKS)


CHUNK_TYPE = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("same", pa.binary()), ("at", pa.int64()),
                        ("letters", pa.string()), ("counts", pa.list_(pa.int64()))])
ROW_TYPE = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("edit", pa.string()), ("fault", pa.string()), ("turn", pa.int64()),
                      ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string())])


def _batch(rows: list[dict], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=kind)


def solved(spark: SparkSession, parts: DataFrame) -> DataFrame:
    """(at, edits) of every chunk. Of a conversation of several chunks, the costs between states, 16 at most a chunk,
    are put together in one task; the edits stay with their chunk."""
    def whole(batches):
        for batch in batches:
            edits = [repair_letters(a, b) for a, b in zip(batch.column("letters").to_pylist(), batch.column("counts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("at"), pa.array(edits, pa.string())], names=["at", "edits"])

    def tables(batches):
        names = ["conv", "at", "entry", "target", "cost", "rank", "edits"]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string()]
        for batch in batches:
            for r in batch.to_pylist():
                table = between_blocks(r["letters"], r["counts"])
                ways = [(r["conv"], r["at"], *way, *rank, table[way][1]) for way, rank in ranked(table).items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ways, strict=True), kinds, strict=True)], names=names)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        ats = sorted(set(rows["at"]))
        by_chunk: dict[int, dict] = {at: {} for at in ats}
        for at, entry, target, cost, rank in rows[["at", "entry", "target", "cost", "rank"]].itertuples(index=False):
            by_chunk[at][entry, target] = cost, rank
        state, steps = forward([by_chunk[at] for at in ats])
        chosen = back(steps, last_state(state))
        ends = [""] * (len(ats) - 1) + [ENDING[chosen[-1][1]][1]]
        return pd.DataFrame([(at, *way, end) for at, way, end in zip(ats, chosen, ends, strict=True)], columns=["at", "entry", "target", "ending"])

    keyed = parts.select(_conv().alias("conv"), "at", "letters", "counts")
    several = keyed.groupBy("conv").agg(F.count("*").alias("n")).filter("n > 1").select("conv")
    ways = staged(spark, keyed.join(several, "conv").mapInArrow(
        tables, "conv string, at long, entry int, target int, cost long, rank int, edits string"), "ways")
    chosen = ways.drop("edits").groupBy("conv").applyInPandas(choose, "at long, entry int, target int, ending string")
    joined = ways.join(chosen, ["at", "entry", "target"]).select("at", F.concat("edits", "ending").alias("edits"))
    return keyed.join(several, "conv", "left_anti").select("at", "letters", "counts").mapInArrow(whole, "at long, edits string").unionByName(joined)


def repair(spark: SparkSession, conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """REPAIRED: every row with its fault and edit, and the inserted rows, in order.

    Rows of a conversation stand together, in order, in one partition. ``position`` counts
    edits from 0; ``edit`` is K, R, D or I; ``role`` is the new role, null for a deleted row;
    an inserted row has no turn or old role and an empty text. Rows go by turn (nulls first),
    those of one turn by role, then by a hash of their text. A null role or text counts as one
    space, a null conv_id as a conversation of its own; a conversation without rows has none
    here. Texts are shuffled once, by conversation, and pass through its task one by one.
    """
    rows = _filled(conversations)
    parts = staged(spark, chunks(lettered(spark, rows), chunk), "chunks")
    edits = staged(spark, solved(spark, parts), "edits")
    none = F.lit(None)
    marks = parts.join(edits, "at").select("conv_id", "turn", "role", "same", "at", none.cast("string").alias("text"), "letters", "counts", "edits")
    texts = rows.select("conv_id", "turn", "role", _same(), F.lit((1 << 63) - 1).alias("at"), "text", none.cast("string").alias("letters"),
                        none.cast("array<long>").alias("counts"), none.cast("string").alias("edits"))
    order = ["conv_id", "turn", "role", "same", "at"]
    return marks.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).mapInArrow(apply_edits, REPAIRED)


FAULT = {"b": "blank", "d": "duplicate"}


def apply_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted marks and texts, with the edits of the marks; a mark comes before its first row."""
    waiting: deque[tuple[str, str, int]] = deque()  # (letter, edit, rows it is for)
    state, position, conv = START, 0, waiting  # no conversation yet
    out: list[dict] = []

    def add(**row):
        nonlocal position
        out.append({"conv_id": conv, "position": position, **row})
        position += 1

    def insert_waiting():
        nonlocal state
        while waiting and waiting[0][1] == "I":
            waiting.popleft()
            state = NEXT[state]
            add(edit="I", role=ROLE[state], text="")

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            for r in batch.slice(at, 500).to_pylist():
                if r["edits"] is not None:
                    if r["conv_id"] != conv:
                        insert_waiting()
                        state, position, conv = START, 0, r["conv_id"]
                    items = zip(r["letters"], r["counts"], strict=True)
                    for edit in r["edits"]:
                        letter, count = ("", 1) if edit == "I" else next(items)
                        waiting.append((letter, edit, count))
                    continue
                insert_waiting()
                letter, edit, count = waiting.popleft()
                if count > 1:
                    waiting.appendleft((letter, edit, count - 1))
                role = None
                if edit == "K":
                    state, role = SYSTEM if letter.upper() == "S" else NEXT[state], r["role"]
                elif edit == "R":
                    state = NEXT[state]
                    role = ROLE[state]
                add(edit=edit, fault=FAULT.get(letter, "truncated" if letter.islower() else None),
                    turn=r["turn"], old_role=r["role"], role=role, text=r["text"])
            if out:
                yield _batch(out, ROW_TYPE)
                out.clear()
    insert_waiting()
    if out:
        yield _batch(out, ROW_TYPE)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut short, repeated or given a wrong role by a hash of their conversation and turn; nulls read as one space."""
    rows = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = rows.withColumn("kind", F.crc32(name.cast("binary")) % 20).filter("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")
COSTS = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}
COUNTED = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a conversation, of the rows of REPAIRED, which stand together and in order. Texts are hashed as they pass."""
    kind = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in COUNTED], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    held: dict = {}
    done: list[dict] = []

    def close():
        if held:
            turns, low, high = held["turns"]
            done.append({"conv_id": held["conv_id"], "gaps": high - low + 1 - turns if turns else 0, "audit": "".join(held["edits"]),
                         "repaired_sha256": held["hash"].hexdigest()} | {c: held[c] for c in COUNTED[1:]})

    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            for r in batch.slice(at, 500).to_pylist():
                if r["position"] == 0:
                    close()
                    held = {"conv_id": r["conv_id"], "turns": (0, 0, 0), "hash": hashlib.sha256(), "lines": 0, "edits": [], "last": None} | dict.fromkeys(COUNTED[1:], 0)
                held["edits"].append(r["edit"])
                held["cost"] += COSTS[r["edit"]] + (UNFINISHED if r["fault"] == "truncated" and r["edit"] != "D" else 0)
                if r["fault"]:
                    held[r["fault"]] += 1
                if r["edit"] != "I":
                    initial = r["old_role"][:1]
                    if held["last"] is not None and held["last"] + initial not in ("su", "ua", "au"):
                        held["illegal"] += 1
                    held["last"] = initial
                    turns, low, high = held["turns"]
                    if r["turn"] is not None and (not turns or r["turn"] != high):
                        held["turns"] = turns + 1, low if turns else r["turn"], r["turn"]
                if r["edit"] != "D":
                    held["hash"].update((("\n" if held["lines"] else "") + r["role"] + ":" + r["text"]).encode())
                    held["lines"] += 1
        if done:
            yield _batch(done, kind)
            done.clear()
    close()
    if done:
        yield _batch(done, kind)


def op13_conversation_repair(spark: SparkSession, root: str) -> DataFrame:
    """The contract's damage is done first. Every conversation of the table has a row, also one that lost all its rows.

    One SHA-256 over all repaired rows of a conversation can't be taken in parts: this query streams
    each conversation through one task, as ``repair`` leaves it.
    """
    given = spark.read.parquet(f"{root}/conversations.parquet")
    found = repair(spark, damaged(given)).mapInArrow(digests, DIGEST).withColumnRenamed("conv_id", "repaired_id")
    every = given.select(F.col("conv_id").cast("long")).distinct()
    zero = F.lit(0).cast("long")
    return every.join(found, every["conv_id"].eqNullSafe(found["repaired_id"]), "left").select(
        "conv_id", *[F.coalesce(F.col(c), zero).alias(c) for c in COUNTED], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
