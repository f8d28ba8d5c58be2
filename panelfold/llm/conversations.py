"""Conversation structure repair with a suffix-shared automaton.

A row's signature is its role's initial and its fault; a conversation's is theirs in order, in chunks of up to
``CHUNK`` rows.  Signatures of all conversations are minimised from the end: equal endings are one node, found by
sorting the distinct signatures from their last row on, where they stand next to each other.  For each node
and each pair of grammar states, the cheapest way from it to the end of its chunk and the least
audit of that cost are computed once, out of the node behind it, for all conversations that have
this ending.  A conversation is then a walk over the tables of its chunks.

No audit of a chunk is the beginning of another one from the same state, as insertions stand before a row
or at the conversation's end; so comparing costs and then audits chunk by chunk gives the least
audit of the whole.

Rows are put in order by a range partitioning that cuts inside conversations too, and repeated rows are found by
aggregation.  What meets in one task for one conversation is 16 small numbers a chunk, and at last its
kept rows, in order and one by one, since the digest of the repaired text is sequential; the audit is one
string by its definition.

Defined results: NULL role and text are one space; rows stand by turn (NULLs first), then by the first 64
characters of role and text, then by a digest of both; an empty role has no initial and cannot be kept; the
conversation of NULL ids is one; a conversation without rows has zeros, an empty audit and the digest of
nothing; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelfold.llm.common import stage

CHUNK = 256
DELETE, REROLE, INSERT, UNFINISHED = 4, 3, 3, 3
_STATES = "0sua"  # nothing yet, then the initial of the last role
_TAIL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))  # from each state to a whole conversation
_GIVEN = {0: 2, 1: 2, 2: 3, 3: 2}  # state after an inserted or renamed row
_ROLES = {2: "user", 3: "assistant"}
_BLANK = r"\A[ \t-\r]*\z"
_FINISHED = r"[.!?][ \t-\r]*\z"
_LEGAL = "s(?=u)|u(?=a)|a(?=u)"


# --- the grammar ------------------------------------------------------------------------------


def _after(state: int, initial: str) -> int | None:
    """State after a kept row."""
    if initial == "s":
        return 1 if state == 0 else None
    if initial == "u":
        return None if state == 2 else 2
    return 3 if initial == "a" and state == 2 else None


def _steps(symbol: str) -> list[list[tuple[int, int, str]]]:
    """By state, (state after, cost, audit) of a row with this symbol and what is inserted before it.

    A symbol is the role's initial, large if the text is unfinished, or D for a row that has to go.
    """
    more = UNFINISHED if symbol.isupper() else 0
    out = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {}
        at = state
        for inserted in range(1 if symbol == "D" else 3):
            found = [(at, DELETE, "D")]
            if symbol != "D":
                found.append((_GIVEN[at], REROLE + more, "R"))
                kept = _after(at, symbol.lower())
                if kept is not None:
                    found.append((kept, more, "K"))
            for to, cost, edit in found:
                way = (cost + INSERT * inserted, "I" * inserted + edit)
                best[to] = min(best.get(to, way), way)
            at = _GIVEN[at]
        out.append([(to, *way) for to, way in best.items()])
    return out


_STEPS = {symbol: _steps(symbol) for symbol in "suaxSUAXD"}
Table = list[list[tuple[int, str] | None]]
_END: Table = [[(0, "") if e == q else None for q in range(4)] for e in range(4)]


def _before(symbol: str, behind: Table) -> Table:
    """The node that reads ``symbol`` and goes on to the node with the table ``behind``."""
    out: Table = []
    for state in range(4):
        row: list[tuple[int, str] | None] = [None] * 4
        for to, cost, audit in _STEPS[symbol][state]:
            for end, rest in enumerate(behind[to]):
                if rest is not None and (row[end] is None or (cost + rest[0], audit + rest[1]) < row[end]):
                    row[end] = (cost + rest[0], audit + rest[1])
        out.append(row)
    return out


class Nodes:
    """Tables of signatures that come in the order of their reversed text; an ending they share is one node."""

    def __init__(self):
        self.path, self.tables, self.made = "", [_END], 0

    def __call__(self, signature: str) -> Table:
        path = signature[::-1]
        same = 0
        while same < min(len(path), len(self.path)) and path[same] == self.path[same]:
            same += 1
        del self.tables[same + 1 :]
        for symbol in path[same:]:
            self.tables.append(_before(symbol, self.tables[-1]))
            self.made += 1
        self.path = path
        return self.tables[-1]


def _flat(table: Table) -> tuple[list[int], list[int], list[str]]:
    """Costs (-1: no way), the audits' places among those of their first state, and the audits."""
    costs, places, audits = [], [], []
    for row in table:
        order = sorted(w[1] for w in row if w is not None)
        for way in row:
            costs.append(-1 if way is None else way[0])
            places.append(-1 if way is None else order.index(way[1]))
            audits.append("" if way is None else way[1])
    return costs, places, audits


def _walk(chunks: list[tuple[list[int], list[int]]]) -> tuple[int, list[int]]:
    """Least cost, and the states between the chunks, from the first to that before the tail."""
    value, choices = [cost for cost, _ in _TAIL], []
    for costs, places in reversed(chunks):
        best = [min((costs[4 * e + q] + value[q], places[4 * e + q], q) for q in range(4) if costs[4 * e + q] >= 0) for e in range(4)]
        value = [b[0] for b in best]
        choices.append([b[2] for b in best])
    states = [0]
    for choice in reversed(choices):
        states.append(choice[states[-1]])
    return value[0], states


# --- Spark ------------------------------------------------------------------------------------


def damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(k, turn, role, text) with one row in five dropped, emptied, unfinished, repeated or given to the user, by a hash of its place."""
    spaced = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced(conversation), spaced(turn)).cast("binary")) % 20
    rows = df.select(_key(conversation).alias("k"), F.col(f"`{turn}`").cast("long").alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), kind.alias("kind"))
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, 2).otherwise(1)
    rows = rows.where("kind <> 0").withColumns({"role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")), "text": body, "times": times})
    return rows.select("k", "turn", "role", "text", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("time")).drop("time")


def _key(conversation: str) -> Column:
    """The id as text; nothing for NULL."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{conversation}`").cast("string")), F.lit(""))


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` in order, with a number that rises with it, their chunk and what is known of each by itself."""
    initial = F.substring("role", 1, 1)
    rows = rows.withColumns({"who": F.md5(F.concat(F.md5("role"), F.md5("text"))), "near_role": F.left("role", F.lit(64)), "near_text": F.left("text", F.lit(64))})
    # Rows that are equal throughout may be cut anywhere, so the range is cut by their number too.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = [F.col("k"), F.col("turn").asc_nulls_first(), F.col("near_role"), F.col("near_text"), F.col("who"), F.col("row")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(
        "k", "turn", "role", "text", "who", F.monotonically_increasing_id().alias("pos"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("initial"),
        F.col("text").rlike(_BLANK).alias("blank"), (~F.col("text").rlike(_FINISHED)).alias("open"),
    )
    return rows.withColumn("chunk", F.floor(F.col("pos") / CHUNK))


def _chunks(ordered: DataFrame) -> DataFrame:
    """(k, chunk, signature, n, blank, duplicate, truncated, legal, first, last) of each conversation's chunks."""
    first = ordered.groupBy("k", "who").agg(F.min("pos").alias("first_pos")).select("first_pos")
    rows = ordered.drop("turn", "role", "text", "who").join(first, F.col("pos") == F.col("first_pos"), "left")
    gone = F.col("blank") | F.col("first_pos").isNull()
    symbol = F.when(gone, "D").when(F.col("open"), F.upper("initial")).otherwise(F.col("initial"))
    each = rows.groupBy("k", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("pos", symbol.alias("symbol"), "initial"))).alias("rows"),
        F.count("*").alias("n"),
        F.count_if("blank").alias("blank"),
        F.count_if(~F.col("blank") & F.col("first_pos").isNull()).alias("duplicate"),
        F.count_if(~gone & F.col("open")).alias("truncated"),
    )
    each = each.withColumns({"signature": F.array_join("rows.symbol", ""), "initials": F.array_join("rows.initial", "")})
    legal = F.regexp_count("initials", F.lit(_LEGAL)).cast("long")
    return each.select("k", "chunk", "signature", "n", "blank", "duplicate", "truncated", legal.alias("legal"), F.left("initials", F.lit(1)).alias("first"), F.right("initials", F.lit(1)).alias("last"))


def _tables(signatures: DataFrame) -> DataFrame:
    """(of, costs, places, audits) of the distinct signatures, by the nodes of their shared endings."""
    reverse = F.reverse("signature")
    rows = signatures.select("signature").distinct().repartitionByRange(reverse).sortWithinPartitions(reverse)

    def run(batches):
        nodes = Nodes()
        for batch in batches:
            each = batch.column(0).to_pylist()
            columns = list(zip(*[_flat(nodes(s)) for s in each])) or [[], [], []]
            types = (pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), t) for c, t in zip(columns, types)]], names=["of", "costs", "places", "audits"])

    return rows.mapInArrow(run, "of string, costs array<int>, places array<int>, audits array<string>")


def _walks(solved: DataFrame) -> DataFrame:
    """(k, figures, path): sums of a conversation's chunks, its cost, and the states each chunk is walked between."""
    sums = [F.sum(c).alias(c) for c in ("n", "blank", "duplicate", "truncated", "legal")]
    each = solved.groupBy("k").agg(*sums, F.array_sort(F.collect_list(F.struct("chunk", "costs", "places", "first", "last"))).alias("chunks"))

    def run(batches):
        for batch in batches:
            figures, paths = [], []
            for row in batch.to_pylist():
                chunks = row["chunks"]
                cost, states = _walk([(c["costs"], c["places"]) for c in chunks])
                legal = row["legal"] + sum(a["last"] + b["first"] in ("su", "ua", "au") for a, b in zip(chunks, chunks[1:]))
                figures.append([row["blank"], row["duplicate"], row["truncated"], row["n"] - 1 - legal, cost, states[-1]])
                paths.append([{"chunk": c["chunk"], "enter": a, "leave": b} for c, a, b in zip(chunks, states, states[1:])])
            kind = pa.list_(pa.struct([("chunk", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(figures, pa.list_(pa.int64())), pa.array(paths, kind)], names=["k", "figures", "path"])

    return each.mapInArrow(run, "k string, figures array<long>, path array<struct<chunk:long,enter:int,leave:int>>")


def _replayed(ordered: DataFrame, solved: DataFrame, walks: DataFrame) -> DataFrame:
    """(k, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of the conversations with rows.

    Each conversation comes as its figures, and then each chunk's audit before the chunk's rows.
    """
    path = walks.select(F.col("k").alias("of_k"), F.inline("path")).withColumnRenamed("chunk", "of_chunk")
    audit = F.element_at("audits", F.col("enter") * 4 + F.col("leave") + 1)
    none = {"figures": F.lit(None).cast("array<long>"), "audit": F.lit(None).cast("string"), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")}
    columns = lambda df, at, pos, **given: df.select("k", at.alias("at"), pos.alias("pos"), *[given.get(c, none[c]).alias(c) for c in none])
    before = F.lit(-1).cast("long")
    heads = columns(walks, before, before, figures=F.col("figures"))
    audits = columns(solved.join(path, (F.col("k") == F.col("of_k")) & (F.col("chunk") == F.col("of_chunk"))), F.col("chunk"), before, audit=audit)
    rows = columns(ordered, F.col("chunk"), F.col("pos"), role=F.col("role"), text=F.col("text"))
    stream = heads.unionAll(audits).unionAll(rows).repartition("k").sortWithinPartitions("k", "at", "pos")

    def run(batches):
        now = None

        def closed():
            now.insert(_TAIL[now.figures[-1]][1])
            return (now.k, *now.figures[:-1], "".join(now.audit), now.digest.hexdigest())

        def out(rows):
            names = ["k", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows)], names=names)

        for batch in batches:
            done = []
            for k, figures, audit, role, text in zip(*[batch.column(c).to_pylist() for c in ("k", "figures", "audit", "role", "text")]):
                if figures is not None:
                    if now is not None:
                        done.append(closed())
                    now = _Replay(k, figures)
                elif audit is not None:
                    now.chunk(audit)
                else:
                    now.row(role, text)
            if done:
                yield out(done)
        if now is not None:
            yield out([closed()])

    return stream.mapInArrow(run, "k string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


class _Replay:
    """One conversation, edited row by row."""

    def __init__(self, k: str, figures: list[int]):
        self.k, self.figures = k, figures
        self.state, self.audit, self.edits, self.at = 0, [], "", 0
        self.digest, self.started = hashlib.sha256(), False

    def emit(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.started else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.started = True

    def insert(self, edits: str) -> None:
        for _ in edits:
            self.state = _GIVEN[self.state]
            self.emit(_ROLES[self.state], "")
        self.audit.append(edits)

    def chunk(self, audit: str) -> None:
        self.audit.append(audit)
        self.edits, self.at = audit, 0

    def row(self, role: str, text: str) -> None:
        while self.edits[self.at] == "I":
            self.state = _GIVEN[self.state]
            self.emit(_ROLES[self.state], "")
            self.at += 1
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = _after(self.state, role[0])
            self.emit(role, text)
        elif edit == "R":
            self.state = _GIVEN[self.state]
            self.emit(_ROLES[self.state], text)


def repair(rows: DataFrame) -> DataFrame:
    """(k, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of rows of (k, turn, role, text)."""
    ordered = stage(_ordered(rows), "turns")
    chunks = stage(_chunks(ordered), "signatures")
    tables = stage(_tables(chunks), "nodes")
    solved = stage(chunks.join(tables, F.col("signature") == F.col("of")).drop("of", "signature"), "solved")
    walks = stage(_walks(solved), "walks")
    turns = ordered.where("turn IS NOT NULL").groupBy("k", "turn").agg(F.lit(1).alias("one")).groupBy("k")
    gaps = turns.agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")).withColumnRenamed("k", "gap_k")
    found = _replayed(ordered, solved, walks).join(gaps, F.col("k") == F.col("gap_k"), "left").drop("gap_k")
    return found.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def repair_damaged(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repair of the damaged rows, one row for every conversation of ``df``."""
    found = repair(damaged(df, conversation, turn, role, text)).withColumnRenamed("k", "found_k")
    each = df.groupBy(_key(conversation).alias("k")).agg(F.first(f"`{conversation}`").alias(conversation))
    out = each.join(found, F.col("k") == F.col("found_k"), "left")
    longs = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(conversation, *longs, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
