"""Repair of conversation structure by a dynamic program that shares prefixes in a trie.

A conversation's signature has one letter a turn: its role's initial (s, u, a or another) and its first
fault. Distinct signatures are sorted, so that those of one range are a prefix trie in depth-first order:
the layers on the path to the last signature form a stack, and a signature computes layers only below the
prefix that it shares with the last one. Its terminal node gives the cheapest edits.

A layer holds, for each state of the wanted order ``(s?(ua)+)?``, the least cost and the place of its
edits among those of the other states in ASCII order. Edits that end with a turn are never prefixes of each
other, so places decide ties without comparing strings, and a layer takes constant time and space.

Turns are sorted into ranges for their signatures, so no conversation is ordered in one task, and repeated
turns are found by adding up hashes (128 bits) of conversation, role and text. Only the digest of a repaired
conversation is sequential by nature: its turns pass through one task as a stream, of which one batch and
the edits are held at a time.

Defined cases: a null role or text counts as one space, null ids and turns as one space in the hash that
decides on damage; turns are ordered by (turn, role, text), null turns first; a null ``conv_id`` is one
conversation; rows that repeat are duplicates of the first; roles are told by their first character; a
conversation without rows after the damage has zeros, no edits and the digest of the empty string; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.shared import bounded, cut, shuffle_partitions

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
ROLES = "sua"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
#: States: nothing yet, a system turn, an open pair, whole pairs.
EMPTY, SYSTEM, OPEN, PAIRED = range(4)
EDITS = ("D", "IK", "IR", "K", "R")
INSERT, REROLE, DELETE = 2, 2, 3
#: Inserts that close a conversation, by its last state.
CLOSING = {EMPTY: "", SYSTEM: "II", OPEN: "I", PAIRED: ""}
_NONE = 255
_FAR = 1 << 60


def damage(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the damaged rows: one in twenty each is dropped, emptied, unpunctuated, repeated, or made a user's."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), code.alias("code")).where("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("code") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def letter(role: Column, fault: Column) -> Column:
    """The signature's letter, A to P, of a role and a fault's number."""
    kind = F.instr(F.lit(ROLES), F.substring(role, 1, 1))
    kind = F.when((F.length(role) > 0) & (kind > 0), kind - 1).otherwise(len(ROLES))
    return F.chr(65 + 4 * kind + fault)


def _joined(order: str, value: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, value))), lambda x: x[value]), "")


def signatures(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """conv_id, signature, gaps of each conversation that has rows."""
    n = ranges or shuffle_partitions(rows.sparkSession)
    order = ["conv_id", "turn", "role", "text"]
    ordered = rows.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
    said = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(said == "", BLANK).when(F.substring(said, -1, 1).isin(*ENDS), FINE).otherwise(TRUNCATED)
    own = [F.xxhash64("conv_id", "role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role", "conv_id").alias("h2")]
    turns = ordered.select("conv_id", "turn", F.monotonically_increasing_id().alias("seq"), letter(F.col("role"), fault).alias("symbol"), letter(F.col("role"), F.lit(DUPLICATE)).alias("again"), (fault == BLANK).alias("blank"), *own)
    turns = cut(turns.withColumn("block", F.shiftright("seq", 33).cast("int")), "turns")
    repeated = turns.groupBy("h1", "h2").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    known = turns.join(repeated, ["h1", "h2"], "left")
    told = known.withColumn("symbol", F.when(~F.col("blank") & (F.col("seq") > F.col("first")), F.col("again")).otherwise(F.col("symbol")))
    pieces = told.groupBy("conv_id", "block").agg(_joined("seq", "symbol").alias("piece"))
    whole = pieces.groupBy("conv_id").agg(_joined("block", "piece").alias("signature"))
    numbers = turns.where("turn is not null").select("conv_id", "turn").distinct()
    gaps = numbers.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).cast("long").alias("gaps"))
    both = whole.unionByName(gaps, allowMissingColumns=True)
    return both.groupBy("conv_id").agg(F.max("signature").alias("signature"), F.coalesce(F.max("gaps"), F.lit(0)).alias("gaps"))


def _moves(kind: int, fault: int) -> list[tuple[int, int, str, int]]:
    """(from state, to state, edits, cost) for a turn; an insert before a deletion is left out, as it may follow at no more cost and less in order."""
    out = [(q, q, "D", DELETE) for q in range(4)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = 1 if fault == TRUNCATED else 0
    for q in range(4):
        for inserted, state in (("", q), ("I", PAIRED if q == OPEN else OPEN)):
            cost = extra + (INSERT if inserted else 0)
            if kind == 0 and state == EMPTY:
                out.append((q, SYSTEM, f"{inserted}K", cost))
            if kind == (2 if state == OPEN else 1):
                out.append((q, PAIRED if state == OPEN else OPEN, f"{inserted}K", cost))
            out.append((q, PAIRED if state == OPEN else OPEN, f"{inserted}R", cost + REROLE))
    return out


MOVES = {chr(65 + 4 * kind + fault): _moves(kind, fault) for kind in range(4) for fault in range(4)}
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class Trie:
    """The layers on the path to the signature that was answered last."""

    def __init__(self) -> None:
        self.path = ""
        self.costs = [(0, _FAR, _FAR, _FAR)]
        self.places = [(0, 0, 0, 0)]
        self.backs: list[bytes] = []
        #: blank, duplicate, truncated and illegal turns up to each layer
        self.counts = [(0, 0, 0, 0)]
        self.computed = 0

    def _descend(self, symbol: str) -> None:
        costs, places = self.costs[-1], self.places[-1]
        best: list[tuple | None] = [None] * 4
        for p, q, edit, cost in MOVES[symbol]:
            if costs[p] < _FAR:
                found = (costs[p] + cost, places[p], edit, p)
                if best[q] is None or found < best[q]:
                    best[q] = found
        ranked = sorted((b[1], b[2], q) for q, b in enumerate(best) if b is not None)
        place = [0] * 4
        for k, (_, _, q) in enumerate(ranked):
            place[q] = k
        self.costs.append(tuple(_FAR if b is None else b[0] for b in best))
        self.places.append(tuple(place))
        self.backs.append(bytes(_NONE if b is None else 8 * b[3] + EDITS.index(b[2]) for b in best))
        kind, fault = divmod(ord(symbol) - 65, 4)
        blank, duplicate, truncated, illegal = self.counts[-1]
        depth = len(self.counts) - 1
        initial = (ROLES + "o")[kind]
        if depth:
            before = (ROLES + "o")[(ord(self.symbols[depth - 1]) - 65) // 4]
            illegal += (before, initial) not in _LEGAL
        self.counts.append((blank + (fault == BLANK), duplicate + (fault == DUPLICATE), truncated + (fault == TRUNCATED), illegal))
        self.computed += 1

    def answer(self, signature: str) -> tuple[int, int, int, int, int, str]:
        """blank, duplicate, truncated, illegal, cost, audit."""
        shared, least = 0, min(len(signature), len(self.path))
        while shared < least and signature[shared] == self.path[shared]:
            shared += 1
        del self.costs[shared + 1 :], self.places[shared + 1 :], self.counts[shared + 1 :], self.backs[shared:]
        self.symbols = self.path = signature
        for symbol in signature[shared:]:
            self._descend(symbol)
        costs, places = self.costs[-1], self.places[-1]
        cost, _, state = min((costs[q] + INSERT * len(CLOSING[q]), places[q], q) for q in range(4) if costs[q] < _FAR)
        edits = [CLOSING[state]]
        for back in reversed(self.backs):
            state, edit = divmod(back[state], 8)
            edits.append(EDITS[edit])
        return (*self.counts[-1], cost, "".join(reversed(edits)))


_ANSWERS = "signature string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def answers(found: DataFrame) -> DataFrame:
    """The cheapest edits of each distinct signature: trie ranges by sorted signatures, one stack of layers a task."""
    n = shuffle_partitions(found.sparkSession)
    distinct = found.select("signature").distinct().repartitionByRange(n, "signature").sortWithinPartitions("signature")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            held = batch.column(0).to_pylist()
            columns = list(zip(*[trie.answer(s) for s in held])) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), *[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.string())], names=[f.split()[0] for f in _ANSWERS.split(", ")])

    return distinct.mapInArrow(run, _ANSWERS)


class Repaired:
    """Digest of a repaired conversation, fed turn by turn."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at = audit, 0
        self.expected = "user"
        self.digest = hashlib.sha256()
        self.lines = 0

    def _line(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1
        self.expected = "assistant" if role[:1] == "u" else "user"

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(self.expected, "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._line(self.expected if edit == "R" else role, text)

    def close(self) -> str:
        self._inserts()
        return self.digest.hexdigest()


_OUT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(turns: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation, its rows damaged first."""
    rows = damage(turns)
    known = signatures(rows).unionByName(turns.select("conv_id").distinct(), allowMissingColumns=True)
    known = known.groupBy("conv_id").agg(F.coalesce(F.max("signature"), F.lit("")).alias("signature"), F.coalesce(F.max("gaps"), F.lit(0)).alias("gaps"))
    known = cut(known, "signatures")
    told = known.join(answers(known), "signature").select("conv_id", *_OUT, F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).alias("part"))
    stream = told.unionByName(rows.withColumns({"turn": F.col("turn").cast("long"), "part": F.lit(1)}), allowMissingColumns=True)
    order = ["conv_id", "part", "turn", "role", "text"]
    dealt = stream.select(*order, *_OUT).repartition(shuffle_partitions(turns.sparkSession), "conv_id").sortWithinPartitions(*order)
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = head = None

        def finished() -> list[tuple]:
            return [] if state is None else [(*head, state.audit, state.close())]

        for batch in batches:
            done: list[tuple] = []
            conv, part, _, role, text, *rest = (c.to_pylist() for c in batch.columns)
            for k in range(len(conv)):
                if part[k] == 0:
                    done += finished()
                    state, head = Repaired(text[k]), (conv[k], *[c[k] for c in rest])
                else:
                    state.turn(role[k], text[k])
            yield _rows(done, batch.schema.field(0).type)
            last = batch.schema.field(0).type
        if state is not None:
            yield _rows(finished(), last)

    columns = [f"conv_id {kind}", *[f"{c} long" for c in _OUT], "audit string", "repaired_sha256 string"]
    return bounded(dealt).mapInArrow(run, ", ".join(columns))


def _rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", *_OUT, "audit", "repaired_sha256"]
    types = [kind, *[pa.int64()] * len(_OUT), pa.string(), pa.string()]
    columns = list(zip(*done)) if done else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
