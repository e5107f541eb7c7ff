"""Repair of the role structure of conversations, with a least-cost audit of the edits.

Rows are kept, given another role or deleted, and empty turns are inserted, until a
conversation's role initials read ``(s?(ua)+)?``. Dynamic programming runs over the
rows with four states: nothing yet, after s, after u, after a. Its audits are
persistent: an edit is a node that links to the edits before it, so all states share
their beginnings. Of equally cheap audits the ASCII-least one wins. Two such audits are
compared by the search for their longest common prefix: nodes carry links to ancestors
1, 2, 4, ... steps back and a rolling hash of what they spell. A comparison by hashes is
verified, and done by letters if it was misled.

Two equally cheap audits of the same rows are never a prefix of one another, as one
would hold more insertions. So the least audit of a conversation is made of the least
audits of its parts for some states between them, and a long conversation can be cut:
rows are sorted over all partitions, by conversation and turn, and cut into segments of
at most ``SEGMENT_ROWS`` rows. A conversation that lies in one segment is settled there.
For any other, each segment gives the least audit for every pair of states, the segments
are chained, and each then repairs its own rows. Rows that repeat exactly are counted
first, and the earliest row of each text comes from an aggregate, so one conversation,
text or row may be a large part of the table. Only the digest of a conversation's text
is read in one task, as a stream: SHA-256 has no parallel form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import ship, stored

SEGMENT_ROWS, SEGMENT_BYTES = 4096, 8 << 20
#: Costs of the edits; a truncated row that stays adds one.
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where one and two insertions lead.
INSERTED = {START: (USER, ASSISTANT), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT, USER), ASSISTANT: (USER, ASSISTANT)}
#: Role initial a state takes by keeping, and the state after it.
TAKES = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
LEGAL = {"su", "ua", "au"}
BASE, PRIME = 911_382_323, (1 << 61) - 1

STATS = ("rows long, blank long, duplicate long, truncated long, illegal long, turns long, min_turn long, "
         "max_turn long, first_initial string, last_initial string")
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
TURNS = "array<struct<role:string,text:string>>"


class Audits:
    """Strings of edits as linked nodes that share their beginnings; node 0 is empty."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.up: list[tuple[int, ...]] = [()]

    def add(self, node: int, letters: str) -> int:
        for letter in letters:
            up, k = [node], 0
            while k < len(self.up[up[k]]):
                up.append(self.up[up[k]][k])
                k += 1
            self.letter.append(letter)
            self.depth.append(self.depth[node] + 1)
            self.hash.append((self.hash[node] * BASE + ord(letter)) % PRIME)
            self.up.append(tuple(up))
            node = len(self.letter) - 1
        return node

    def spell(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(letters))

    def lifted(self, node: int, steps: int) -> int:
        while steps:
            k = steps.bit_length() - 1
            node = self.up[node][k]
            steps -= 1 << k
        return node

    def less(self, a: int, b: int) -> bool:
        """Whether ``a`` spells a smaller string than ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, self.depth[a] - depth), self.lifted(b, self.depth[b] - depth)
        if self.hash[x] != self.hash[y]:
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]) and self.hash[self.up[x][k]] != self.hash[self.up[y][k]]:
                    x, y = self.up[x][k], self.up[y][k]
            if self.letter[x] != self.letter[y] and self.same(self.up[x][0], self.up[y][0]):
                return self.letter[x] < self.letter[y]
        elif self.same(x, y):
            return self.depth[a] < self.depth[b]
        return self.spell(a) < self.spell(b)  # two strings with one hash

    def same(self, x: int, y: int) -> bool:
        """Whether two nodes of one depth spell the same, letter by letter up to a shared node."""
        while x != y:
            if self.letter[x] != self.letter[y]:
                return False
            x, y = self.up[x][0], self.up[y][0]
        return True


class Best:
    """Cheapest and then least audit of each state."""

    def __init__(self, audits: Audits):
        self.audits = audits
        self.held: list[tuple[int, int, str] | None] = [None] * 4

    def offer(self, state: int, cost: int, node: int, letters: str) -> None:
        held = self.held[state]
        if held is None or cost < held[0]:
            self.held[state] = (cost, node, letters)
        elif cost == held[0]:
            old, new = self.audits.add(held[1], held[2]), self.audits.add(node, letters)
            self.held[state] = (cost, new if self.audits.less(new, old) else old, "")

    def settled(self) -> list[tuple[int, int] | None]:
        return [h and (h[0], self.audits.add(h[1], h[2])) for h in self.held]


def inserted(audits: Audits, vector: list) -> list:
    """Each state with up to two insertions behind it."""
    best = Best(audits)
    for state, held in enumerate(vector):
        if held:
            best.offer(state, *held, "")
            for n, then in enumerate(INSERTED[state], 1):
                best.offer(then, held[0] + n * INSERT, held[1], "I" * n)
    return best.settled()


def advanced(audits: Audits, vector: list, initial: str, forced: bool, truncated: bool) -> list:
    """The states behind one more row, for the states before it."""
    best, more = Best(audits), CUT_SHORT if truncated else 0
    for state, held in enumerate(inserted(audits, vector)):
        if held:
            cost, node = held
            best.offer(state, cost + DELETE, node, "D")
            if not forced:
                if (then := TAKES[state].get(initial)) is not None:
                    best.offer(then, cost + KEEP + more, node, "K")
                best.offer(INSERTED[state][0], cost + REROLE + more, node, "R")
    return best.settled()


def accepted(audits: Audits, vector: list) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    best = Best(audits)
    ends = inserted(audits, vector)
    for state in (START, ASSISTANT):
        if ends[state]:
            best.offer(START, *ends[state], "")
    cost, node = best.settled()[START]
    return cost, audits.spell(node)


def repaired(rows: Iterable[tuple[bytes, bytes]], audit: str, state: int = START) -> list[tuple[bytes, bytes]]:
    """Role and text of the rows after the edits of an audit, from a state on."""
    out, rows = [], iter(rows)
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        then = INSERTED[state][0]
        role, text = (b"", b"") if edit == "I" else next(rows)
        if edit == "K":
            then = TAKES[state][initial_of(role)]
        else:
            role = b"user" if then == USER else b"assistant"
        out.append((role, text))
        state = then
    return out


def initial_of(role: bytes) -> str:
    return role[:1].decode("ascii", "replace")


class Segment:
    """Rows of one conversation that stand together, with their faults."""

    def __init__(self, conv: int | None, known: bool):
        self.conv, self.known = conv, known
        self.rows: list[tuple[bytes, bytes]] = []
        self.faults: list[tuple[bool, bool]] = []  # must go, truncated
        self.bytes = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None

    def full(self) -> bool:
        return len(self.rows) >= SEGMENT_ROWS or self.bytes >= SEGMENT_BYTES

    def add(self, turn: int | None, role: bytes, text: bytes, first: bool) -> None:
        ended = text.rstrip()
        blank, duplicate = not ended, not first
        truncated = not blank and not duplicate and ended[-1:] not in (b".", b"!", b"?")
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated
        self.illegal += bool(self.rows) and initial_of(self.rows[-1][0]) + initial_of(role) not in LEGAL
        if turn is not None and turn != self.high:
            self.turns += 1
            self.high = turn
            self.low = turn if self.low is None else self.low
        self.rows.append((role, text))
        self.faults.append((blank or duplicate, truncated))
        self.bytes += len(role) + len(text)

    def stats(self) -> dict:
        return {"rows": len(self.rows), "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "turns": self.turns, "min_turn": self.low, "max_turn": self.high,
                "first_initial": initial_of(self.rows[0][0]), "last_initial": initial_of(self.rows[-1][0])}

    def vector(self, audits: Audits, state: int) -> list:
        vector: list = [None] * 4
        vector[state] = (0, 0)
        for (role, _), (forced, truncated) in zip(self.rows, self.faults):
            vector = advanced(audits, vector, initial_of(role), forced, truncated)
        return vector

    def settled(self) -> dict:
        """The report of a whole conversation, with its repaired turns."""
        audits = Audits()
        cost, audit = accepted(audits, self.vector(audits, START))
        return {"report": _report([self.stats()], cost, audit), "turns": _turns(repaired(self.rows, audit))}

    def paths(self) -> list[dict]:
        """Least audits for each state before the segment and behind it."""
        audits = Audits()
        return [{"entry": entry, "exit": exit_, "cost": held[0], "audit": audits.spell(held[1])}
                for entry in ((START,) if self.known else range(4))
                for exit_, held in enumerate(self.vector(audits, entry)) if held]


def _turns(rows: list[tuple[bytes, bytes]]) -> list[dict]:
    return [{"role": r, "text": t} for r, t in rows]


def _report(parts: list[dict], cost: int, audit: str) -> dict:
    """The numbers of a conversation from those of its segments, in order."""
    out = {k: sum(p[k] for p in parts) for k in ("blank", "duplicate", "truncated", "illegal")}
    out["illegal"] += sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in zip(parts, parts[1:]))
    known = [p for p in parts if p["turns"]]
    turns = sum(p["turns"] for p in known) - sum(a["max_turn"] == b["min_turn"] for a, b in zip(known, known[1:]))
    gaps = known[-1]["max_turn"] - known[0]["min_turn"] + 1 - turns if known else 0
    return {"gaps": gaps, **out, "cost": cost, "audit": audit}


SEGMENTS = (f"conv long, part long, seg long, stats struct<{STATS.replace(' ', ':').replace(',:', ',')}>, "
            f"report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>, "
            f"paths array<struct<entry:int,exit:int,cost:long,audit:string>>, turns {TURNS}")


def _arrow(ddl: str) -> pa.Schema:
    """Arrow types of a flat list of long, int and string columns."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.struct([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(", "))])


_TURN = pa.list_(pa.struct([("role", pa.binary()), ("text", pa.binary())]))
_TEXT_TURN = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_SEGMENT = pa.schema([
    ("conv", pa.int64()), ("part", pa.int64()), ("seg", pa.int64()), ("stats", _arrow(STATS)), ("report", _arrow(REPORT)),
    ("paths", pa.list_(_arrow("entry int, exit int, cost long, audit string"))), ("turns", _TURN)])


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size; turns are bytes that Spark reads as strings."""
    held, size = [], 0

    def batch():
        made = pa.RecordBatch.from_pylist(held, schema)
        kinds = pa.schema([pa.field(f.name, _TEXT_TURN if f.type == _TURN else f.type) for f in schema])
        return pa.record_batch([_viewed(c) if c.type == _TURN else c for c in made.columns], schema=kinds)

    for row in rows:
        held.append(row)
        size += 200 + sum(20 + len(t["text"]) for t in row.get("turns") or ())
        if size >= SEGMENT_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _viewed(column: pa.ListArray) -> pa.ListArray:
    turns = column.flatten()
    strings = pa.StructArray.from_arrays([turns.field(0).view(pa.string()), turns.field(1).view(pa.string())], ["role", "text"])
    return pa.ListArray.from_arrays(column.offsets, strings, mask=column.is_null()) if column.null_count else \
        pa.ListArray.from_arrays(column.offsets, strings)


def _split(batches) -> Iterator[dict]:
    """Segments of the sorted rows of one partition."""
    part, number, held, first = TaskContext.get().partitionId(), 0, None, False
    started = 0  # conversations begun in this partition

    def ended(segment: Segment, whole: bool) -> dict:
        base = {"conv": segment.conv, "part": part, "seg": number, "stats": segment.stats()}
        return base | (segment.settled() if whole else {"paths": segment.paths(), "turns": _turns(segment.rows)})

    pieces = 0
    for batch in batches:
        columns = [batch.column(k) for k in range(batch.num_columns)]
        columns[2:4] = [c.cast(pa.binary()) for c in columns[2:4]]
        for conv, turn, role, text, n in zip(*(c.to_pylist() for c in columns)):
            if not n:  # names the first row of its text, which comes next
                first = True
                continue
            if started == 0 or held.conv != conv:
                if held:
                    # The first conversation of a partition may have begun before it.
                    yield ended(held, started > 1 and pieces == 0)
                    number += 1
                started, pieces = started + 1, 0
                held = Segment(conv, started > 1)
            for _ in range(n):
                if held.full():
                    yield ended(held, False)
                    number, pieces = number + 1, pieces + 1
                    held = Segment(conv, False)
                held.add(turn, role, text, first)
                first = False
    if held:
        yield ended(held, False)  # it may go on in the next partition


def _chained(batches) -> Iterator[dict]:
    """Of sorted segments without their texts: the audit and state before each, the report at the last."""
    conv, parts = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if parts and row["conv"] != conv:
                yield from _chain(parts)
                parts = []
            conv = row["conv"]
            parts.append(row)
    if parts:
        yield from _chain(parts)


def _least(a: tuple, b: tuple) -> tuple:
    """The cheaper of two chains ``(cost, links)`` and of equals the one that spells less.

    A link is ``(link before, entry state, audit)``; both chains cover the same segments.
    """
    if a[0] != b[0]:
        return min(a, b, key=lambda chain: chain[0])
    left, right, x, y = [], [], a[1], b[1]
    while x is not y:
        left.append(x[2])
        right.append(y[2])
        x, y = x[0], y[0]
    return a if "".join(reversed(left)) <= "".join(reversed(right)) else b


def _chain(parts: list[dict]) -> Iterator[dict]:
    best = {START: (0, None)}
    for part in parts:
        after: dict = {}
        for path in part["paths"]:
            if path["entry"] in best:
                cost, link = best[path["entry"]]
                new = (cost + path["cost"], (link, path["entry"], path["audit"]))
                after[path["exit"]] = _least(after[path["exit"]], new) if path["exit"] in after else new
        best = after
    ends = []
    for state, (cost, link) in best.items():
        missing = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}[state]
        ends.append((cost + INSERT * len(missing), (link[0], link[1], link[2] + missing)))
    cost, link = ends[0]
    for other in ends[1:]:
        cost, link = _least((cost, link), other)
    links = []
    while link:
        links.append(link)
        link = link[0]
    links.reverse()
    report = _report([p["stats"] for p in parts], cost, "".join(x[2] for x in links))
    for k, (part, (_, entry, audit)) in enumerate(zip(parts, links)):
        yield {"conv": part["conv"], "part": part["part"], "seg": part["seg"], "piece": k, "entry": entry, "audit": audit,
               "report": report if k == len(parts) - 1 else None}


_CHOICE = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("seg", pa.int64()), ("piece", pa.int64()),
                     ("entry", pa.int32()), ("audit", pa.string()), ("report", _arrow(REPORT))])
CHOICES = ("conv long, part long, seg long, piece long, entry int, audit string, "
           f"report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>")


def _digested(batches) -> Iterator[dict]:
    """Of the sorted pieces of each conversation: its report and the digest of all pieces, as a stream."""
    digest, empty = hashlib.sha256(), True
    for batch in batches:
        lines = batch.column(1).cast(pa.binary())
        for conv, line, report in zip(batch.column(0).to_pylist(), lines.to_pylist(), batch.column(2).to_pylist()):
            if line is not None:
                digest.update(line if empty else b"\n" + line)
                empty = False
            if report:
                yield {"conv": conv, "report": report, "repaired_sha256": digest.hexdigest()}
                digest, empty = hashlib.sha256(), True


_DIGEST = pa.schema([("conv", pa.int64()), ("report", _arrow(REPORT)), ("repaired_sha256", pa.string())])


def _ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turn, role, text, n`` sorted over all partitions; a row of ``n`` 0 names the first row of a text."""
    def string(name):
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))

    rows = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                     string(role_col).alias("role"), string(text_col).alias("text"))
    counted = (rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("key", F.unhex(F.sha2("text", 256))))
    firsts = counted.groupBy("conv", "role", "key").agg(
        F.min("turn").alias("turn"), F.max(F.col("turn").isNull()).alias("unknown"))
    marks = firsts.select("conv", F.when(~F.col("unknown"), F.col("turn")).alias("turn"), "role", "key",
                          F.lit("").alias("text"), F.lit(0).cast("long").alias("n"))
    both = counted.select("conv", "turn", "role", "key", "text", "n").unionByName(marks)
    return (both.repartitionByRange("conv", "turn", "role", "key")
            .sortWithinPartitions("conv", "turn", "role", "key", "n").select("conv", "turn", "role", "text", "n"))


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Reports and repaired turns of every conversation.

    Reports: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256``. Turns: ``conv_id, piece, place, role, text``, in the order of piece and
    place. Rows go by turn, null first; of one turn by role and then by the SHA-256 of the text.
    A null role or text is one blank. Rows without conversation are one conversation. A row's
    first fault counts: blank, duplicate (role and text of an earlier row, so also the second of
    two equal rows), truncated. An empty role or one that starts with neither s, u nor a can't be
    kept. An empty table gives no rows.
    """
    ship(df.sparkSession)
    segments = stored(_ordered(df, conv_col, turn_col, role_col, text_col).mapInArrow(
        lambda batches: _batches(_split(batches), _SEGMENT), SEGMENTS), "segments")
    whole, cut = segments.filter("report IS NOT NULL"), segments.filter("report IS NULL")
    line = F.transform("turns", lambda t: F.concat(t.role, F.lit(":"), t.text))
    settled = whole.select("conv", "report", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))

    choices = stored(cut.select("conv", "part", "seg", "stats", "paths").repartition("conv")
                     .sortWithinPartitions("conv", "part", "seg")
                     .mapInArrow(lambda batches: _batches(_chained(batches), _CHOICE), CHOICES), "choices")
    pieces = (cut.select("part", "seg", "turns").join(choices, ["part", "seg"])
              .mapInArrow(_applied, f"conv long, piece long, report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>, turns {TURNS}"))
    digested = (pieces.select("conv", F.when(F.size("turns") > 0, F.array_join(line, "\n")).alias("lines"), "report", "piece")
                .repartition("conv").sortWithinPartitions("conv", "piece")
                .mapInArrow(lambda batches: _batches(_digested(batches), _DIGEST),
                            f"conv long, report struct<{REPORT.replace(' ', ':').replace(',:', ',')}>, repaired_sha256 string"))
    reports = settled.unionByName(digested).select(F.col("conv").alias("conv_id"), "report.*", "repaired_sha256")
    turns = (whole.select("conv", F.lit(0).cast("long").alias("piece"), "turns")
             .unionByName(pieces.select("conv", "piece", "turns"))
             .select(F.col("conv").alias("conv_id"), "piece", F.posexplode("turns").alias("place", "turn"))
             .select("conv_id", "piece", "place", "turn.*"))
    return reports, turns


def _applied(batches) -> Iterator[pa.RecordBatch]:
    """Each segment's rows after the edits chosen for it."""
    schema = pa.schema([("conv", pa.int64()), ("piece", pa.int64()), ("report", _arrow(REPORT)), ("turns", _TURN)])

    def rows():
        for batch in batches:
            for row in batch.to_pylist():
                own = [(t["role"].encode(), t["text"].encode()) for t in row["turns"]]
                yield {"conv": row["conv"], "piece": row["piece"], "report": row["report"],
                       "turns": _turns(repaired(own, row["audit"], row["entry"]))}

    return _batches(rows(), schema)


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with faults put in, by crc32 of ``conv_id:turn`` modulo 20, as a test of the repair.

    0 drops a row, 1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes it the user's.
    Nulls are one blank, in that name too.
    """
    def string(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(string("conv_id"), F.lit(":"), string("turn"))) % 20
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     string("role").alias("role"), string("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
            .drop("copy"))
