"""Conversation structure repair by grammar-compressed dynamic programming (operator 11).

A conversation's rows become a string of symbols, one per row: the role's initial
(system, user, assistant, other) and the row's first fault (blank, duplicate,
truncated or none). The cheapest edits that leave a conversation of the form
``(s?(ua)+)?`` are a shortest path through four states (nothing, after system,
after user, after assistant), so a symbol is a 4 x 4 min-plus matrix and a string
the product of its symbols' matrices.

Grammar: Re-Pair rounds over all distinct strings. In each round Spark counts the
digrams, the most frequent ones that do not compete become rules, and strings
are rewritten. A rule's matrix is the product of its two parts' matrices, worked
out once, bottom-up, and shared by all conversations. The number of rules is
bounded by ``ROUNDS`` and ``PER_ROUND``; it decides how much work is shared,
never the result: what no rule covers is multiplied symbol by symbol.

Ties: among the cheapest edits the ASCII-least audit counts. A symbol's audit is
its inserts and then its own letter, so the audits of one string all end with
their last row's letter and none begins another: comparing two concatenations is
comparing their first parts, then their second. A matrix therefore carries, for
each row, only the order (rank) of its audits, and the audit itself is a rope:
per entry the middle state, read top-down through the rules.

Jobs: rows are dealt by ranges of (conversation, turn), so any conversation may
hold any share of the rows; strings are cut into segments of at most ``SEGMENT``
rows, each segment's matrix is made apart, and per conversation only the
matrices are chained. The repaired text is digested in order by one task per
conversation, streaming (a sha256 over a whole conversation cannot be split).

Cases: null role and text are one space, a null conversation or turn is one space
in the damage key; a null turn sorts first; rows of one turn are ordered by role
and the sha256 of their text; null ``conv_id`` is one conversation; a conversation without rows after
damage has zeros, an empty audit and the hash of the empty string; an empty
table gives no rows; extra columns are ignored. An audit must fit one string (2 GB).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dumpwise.llm.common import partitions, staged

INITIALS = "sua"  # any other initial is 3
OK, TRUNCATED, BLANK, DUPLICATE = range(4)
FIRST_SYMBOL, FIRST_RULE = ord("a"), 0xE000  # symbol a + 4 * role + fault; rules in the private-use area
LEGAL = {(0, 1), (1, 2), (2, 1)}

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
INSERTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # state after one inserted row
KEPT = {(NOTHING, 0): SYSTEM, **{(s, 1): USER for s in (NOTHING, SYSTEM, ASSISTANT)}, (USER, 2): ASSISTANT}
REROLE, DELETE, INSERT, UNMENDED = 2, 3, 2, 1
CLOSING = {NOTHING: (0, ""), SYSTEM: (4, "II"), USER: (2, "I"), ASSISTANT: (0, "")}

SEGMENT = 1 << 12
ROUNDS, PER_ROUND = 8, 48
MEMO_STRINGS = 50_000
INF = 1 << 60


class Matrix:
    """Min-plus transfer matrix: cost and rank (order of audits within a row) for each (from, to) state."""

    __slots__ = ("cost", "rank", "illegal", "first", "last")

    def __init__(self, cost: list[list[int]], rank: list[list[int]], illegal: int, first: int, last: int):
        self.cost, self.rank, self.illegal, self.first, self.last = cost, rank, illegal, first, last


class Leaf(Matrix):
    """One row: any inserts before it, then Keep, Rerole or Delete."""

    __slots__ = ("audits",)

    def __init__(self, role: int, fault: int):
        best: list[list[tuple[int, str]]] = [[(INF, "")] * 4 for _ in range(4)]
        extra = UNMENDED if fault == TRUNCATED else 0
        for start in range(4):
            state, inserts = start, 0
            while inserts < 4:
                edits = [(DELETE, "D", state)]
                if fault not in (BLANK, DUPLICATE):
                    edits.append((REROLE + extra, "R", INSERTED[state]))
                    if (state, role) in KEPT:
                        edits.append((extra, "K", KEPT[state, role]))
                for cost, letter, to in edits:
                    best[start][to] = min(best[start][to], (cost + INSERT * inserts, "I" * inserts + letter))
                state, inserts = INSERTED[state], inserts + 1
        self.audits = [[audit for _, audit in row] for row in best]
        rank = [[sorted(row).index(a) if c < INF else 9 for (c, _), a in zip(best[p], row)] for p, row in enumerate(self.audits)]
        super().__init__([[c for c, _ in row] for row in best], rank, 0, role, role)

    def audit(self, p: int, q: int) -> str:
        return self.audits[p][q]


class Rule(Matrix):
    """Two parts one after the other; the audit of an entry is a rope through ``mid``."""

    __slots__ = ("a", "b", "mid", "ropes")

    def __init__(self, a: Matrix, b: Matrix):
        self.a, self.b, self.ropes = a, b, {}
        cost, rank, self.mid = zip(*(chained(a.cost[p], a.rank[p], b) for p in range(4)))
        super().__init__(cost, rank, a.illegal + b.illegal + ((a.last, b.first) not in LEGAL), a.first, b.last)

    def audit(self, p: int, q: int) -> str:
        if (p, q) not in self.ropes:
            k = self.mid[p][q]
            self.ropes[p, q] = self.a.audit(p, k) + self.b.audit(k, q)
        return self.ropes[p, q]


def chained(cost: list[int], rank: list[int], b: Matrix) -> tuple[list[int], list[int], list[int]]:
    """A row of costs and ranks, one part further: new costs, new ranks and the state passed in between."""
    mid, total = [0] * 4, [INF] * 4
    for q in range(4):
        total[q], _, mid[q] = min((min(cost[k] + b.cost[k][q], INF), rank[k], k) for k in range(4))
    order = sorted((rank[mid[q]], b.rank[mid[q]][q], q) for q in range(4) if total[q] < INF)
    ranks = [9] * 4
    for i, (_, _, q) in enumerate(order):
        ranks[q] = i
    return total, ranks, mid


class Grammar:
    """Matrices of all symbols and rules; ``pairs`` are the rules in the order they were made."""

    def __init__(self, pairs: tuple[str, ...]):
        self.pairs = pairs
        self.parts: dict[str, Matrix] = {chr(FIRST_SYMBOL + 4 * role + fault): Leaf(role, fault) for role in range(4) for fault in range(4)}
        for i, pair in enumerate(pairs):
            self.parts[chr(FIRST_RULE + i)] = Rule(self.parts[pair[0]], self.parts[pair[1]])
        self.memo: dict[str, Matrix] = {}

    def compressed(self, symbols: str) -> str:
        return rewritten(symbols, self.pairs, 0)

    def matrix(self, symbols: str) -> Matrix:
        """The matrix of a string: its rules' matrices, chained by halves."""
        if symbols not in self.memo:
            if len(self.memo) >= MEMO_STRINGS:
                self.memo = {}
            parts = [self.parts[c] for c in self.compressed(symbols)]
            while len(parts) > 1:
                parts = [Rule(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
            self.memo[symbols] = parts[0]
        return self.memo[symbols]


def rewritten(symbols: str, pairs: tuple[str, ...], known: int) -> str:
    """``symbols`` with the rules from number ``known`` on put in for their pairs."""
    for i in range(known, len(pairs)):
        if pairs[i] in symbols:
            symbols = symbols.replace(pairs[i], chr(FIRST_RULE + i))
    return symbols


@lru_cache(maxsize=2)
def grammar_of(pairs: tuple[str, ...]) -> Grammar:
    """One grammar per worker."""
    return Grammar(pairs)


def learn_pairs(strings: DataFrame, rounds: int = ROUNDS, per_round: int = PER_ROUND) -> tuple[str, ...]:
    """Re-Pair in rounds over all rows of ``strings`` (symbols, n): the digram counts are aggregated by Spark.

    Only the leading digrams of a round (at most 4 x ``per_round`` rows) reach the driver. Digrams that
    share a symbol with a more frequent one of the round wait for the next; one seen once makes no rule.
    """
    pairs: tuple[str, ...] = ()
    for _ in range(rounds):
        known = pairs

        def digrams(batches: Iterator[pa.RecordBatch], known: tuple[str, ...] = known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                seen: dict[str, int] = {}
                for symbols, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    text = rewritten(symbols, known, 0)
                    for i in range(len(text) - 1):
                        seen[text[i : i + 2]] = seen.get(text[i : i + 2], 0) + n
                if seen:
                    yield pa.RecordBatch.from_pydict({"pair": list(seen), "n": pa.array(seen.values(), pa.int64())})

        counts = strings.mapInArrow(digrams, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).where("n > 1")
        chosen, used = [], set()
        for row in counts.orderBy(F.desc("n"), "pair").limit(4 * per_round).collect():
            if len(chosen) < per_round and not used & set(row["pair"]):
                chosen.append(row["pair"])
                used |= set(row["pair"])
        if not chosen:
            break
        pairs += tuple(chosen)
    return pairs


# ------------------------------------------------------------------ damage and faults


def damaged(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows after damage, by crc32 of ``conv_id:turn`` modulo 20 (0 drop, 1 empty, 2 no sentence ends, 3 repeat, 4 role user)."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told(conv_col), F.lit(":"), told(turn_col))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(told(text_col), ".!?", "")).otherwise(told(text_col))
    copies = F.when(kind == 0, F.lit(0)).when(kind == 3, F.lit(2)).otherwise(F.lit(1))
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.when(kind == 4, F.lit("user")).otherwise(told(role_col)).alias("role"),
        text.alias("text"), copies.alias("copies"),
    )
    return rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")


def in_order(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, ascending by conversation, turn, role and text hash over the whole table; staged."""
    n = partitions(rows.sparkSession)
    order = ["conv_id", "turn", "role", "text_key", "salt"]
    keyed = rows.withColumns({"text_key": F.sha2("text", 256), "salt": F.monotonically_increasing_id()})
    dealt = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("salt")
    return staged(dealt.withColumn("pos", F.monotonically_increasing_id()), "repair-rows")


def with_symbols(rows: DataFrame) -> DataFrame:
    """``rows`` with their ``symbol``: role and first fault."""
    sets = "[^\\x20\\x09-\\x0D]"
    blank = ~F.col("text").rlike(sets)
    ended = F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    same = F.sha2(F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.lit(":"), "text_key", "role"), 256)
    lean = rows.select("conv_id", "pos", "role", same.alias("same"), blank.alias("blank"), ended.alias("ended"))
    # the first of equal rows, partially aggregated; the rows' side of the join may be split where a text is hot
    joined = lean.join(rows.select(same.alias("same"), "pos").groupBy("same").agg(F.min("pos").alias("first_pos")), "same")
    fault = F.when(F.col("blank"), BLANK).when(F.col("pos") > F.col("first_pos"), DUPLICATE).when(~F.col("ended"), TRUNCATED).otherwise(OK)
    initial = F.substring("role", 1, 1)
    role = F.when(initial == INITIALS[0], 0).when(initial == INITIALS[1], 1).when(initial == INITIALS[2], 2).otherwise(3)
    return joined.select("conv_id", "pos", F.char(F.lit(FIRST_SYMBOL) + 4 * role + fault).alias("symbol"))


# ------------------------------------------------------------------------------- repair


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per original conversation: gaps, faults, cost, audit and the digest of the repaired rows."""
    spark = conversations.sparkSession
    n = partitions(spark)
    rows = in_order(damaged(conversations, conv_col, turn_col, role_col, text_col))
    segment = F.shiftright("pos", SEGMENT.bit_length() - 1)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "symbol")))  # at most SEGMENT rows
    strings = with_symbols(rows).groupBy("conv_id", segment.alias("seg")).agg(F.array_join(F.transform(ordered, lambda x: x["symbol"]), "").alias("symbols"))
    strings = staged(strings, "repair-strings")
    pairs = learn_pairs(strings.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = grammar_of(pairs)
        for batch in batches:
            found = [grammar.matrix(s) for s in batch.column(2).to_pylist()]
            flat = lambda rows: [x for row in rows for x in row]
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column(0), "seg": batch.column(1), "symbols": batch.column(2), "cost": pa.array([flat(m.cost) for m in found], pa.list_(pa.int64())),
                "rank": pa.array([flat(m.rank) for m in found], pa.list_(pa.int64())), "ends": pa.array([[m.illegal, m.first, m.last] for m in found], pa.list_(pa.int64())),
            })

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = grammar_of(pairs)
        for conv_id, segments in by_conversation(batches):
            yield chain(grammar, conv_id, segments)

    made = strings.select("conv_id", "seg", "symbols").mapInArrow(matrices, "conv_id long, seg long, symbols string, cost array<long>, rank array<long>, ends array<long>")
    audits = made.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(paths, "conv_id long, seg long, audit string, counts array<long>")
    none = lambda kind: F.lit(None).cast(kind)
    # per conversation: its entry, then each segment's audit followed by the segment's rows
    entries = conversations.select(F.col(conv_col).cast("long").alias("conv_id")).distinct()
    shape = ["conv_id", "seg", "pos", "turn", "role", "text", "audit", "counts"]
    told = [
        entries.select("conv_id", F.lit(-1).cast("long").alias("seg"), F.lit(-1).cast("long").alias("pos"), none("long").alias("turn"), none("string").alias("role"),
                       none("string").alias("text"), none("string").alias("audit"), none("array<long>").alias("counts")),
        audits.select("conv_id", "seg", F.lit(-1).cast("long").alias("pos"), none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), "audit", "counts"),
        rows.select("conv_id", segment.alias("seg"), "pos", "turn", "role", "text", none("string").alias("audit"), none("array<long>").alias("counts")),
    ]
    whole = told[0].unionByName(told[1]).unionByName(told[2]).select(*shape)
    schema = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_rows long, n_repaired long"
    return whole.repartition(n, "conv_id").sortWithinPartitions("conv_id", "seg", "pos").mapInArrow(reports, schema)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            yield from batch.slice(i, 256).to_pylist()


def by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[dict]]]:
    """Consecutive segments of the same conversation (its matrices: a 4096th of its rows)."""
    held: list[dict] = []
    for row in slices(batches):
        if held and held[-1]["conv_id"] != row["conv_id"]:
            yield held[0]["conv_id"], held
            held = []
        held.append(row)
    if held:
        yield held[0]["conv_id"], held


def chain(grammar: Grammar, conv_id: int | None, segments: list[dict]) -> pa.RecordBatch:
    """Chain a conversation's segments, choose the cheapest path and read its audits off the ropes."""
    cost, rank, mids, illegal, last = [0, INF, INF, INF], [0, 9, 9, 9], [], 0, None
    for s in segments:
        square = lambda x: [x[i : i + 4] for i in range(0, 16, 4)]
        inner, first, end = s["ends"]
        cost, rank, mid = chained(cost, rank, Matrix(square(s["cost"]), square(s["rank"]), inner, first, end))
        mids.append(mid)
        illegal += inner + (last is not None and (last, first) not in LEGAL)
        last = end
    total, _, state = min((min(cost[q] + CLOSING[q][0], INF), rank[q], q) for q in range(4))
    audits, closing = [], CLOSING[state][1]
    for s, mid in zip(reversed(segments), reversed(mids)):
        audits.append(grammar.matrix(s["symbols"]).audit(mid[state], state))
        state = mid[state]
    audits.reverse()
    audits[-1] += closing
    faults = [sum(s["symbols"].count(chr(FIRST_SYMBOL + 4 * role + fault)) for s in segments for role in range(4)) for fault in (BLANK, DUPLICATE, TRUNCATED)]
    counts = [[*faults, illegal, total]] + [None] * (len(segments) - 1)
    return pa.RecordBatch.from_pydict({
        "conv_id": pa.array([conv_id] * len(segments), pa.int64()), "seg": pa.array([s["seg"] for s in segments], pa.int64()), "audit": pa.array(audits, pa.string()),
        "counts": pa.array(counts, pa.list_(pa.int64())),
    })


class Report:
    """One conversation, row by row in order: applies the audit and digests what is left."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.counts, self.audit = conv_id, [0] * 5, []
        self.digest, self.state = hashlib.sha256(), NOTHING
        self.rows = self.repaired = self.distinct = 0
        self.low = self.high = None

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.repaired else ''}{role}:{text}".encode())
        self.repaired += 1
        self.state = KEPT.get((self.state, INITIALS.find(role[0])), NOTHING)

    def inserts(self) -> None:
        while self.at < len(self.audit[-1]) and self.audit[-1][self.at] == "I":
            self.put(ROLE_OF[INSERTED[self.state]], "")
            self.at += 1

    def segment(self, audit: str, counts: list[int] | None) -> None:
        if self.audit:
            self.inserts()
        self.audit.append(audit)
        self.at = 0
        self.counts = counts or self.counts

    def row(self, turn: int | None, role: str, text: str) -> None:
        self.rows += 1
        if turn is not None and turn != self.high:
            self.distinct += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.inserts()
        letter = self.audit[-1][self.at]
        self.at += 1
        if letter != "D":
            self.put(role if letter == "K" else ROLE_OF[INSERTED[self.state]], text)

    def result(self) -> list:
        if self.audit:
            self.inserts()
        blank, duplicate, truncated, illegal, cost = self.counts
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return [self.conv_id, gaps, blank, duplicate, truncated, illegal, cost, "".join(self.audit), self.digest.hexdigest(), self.rows, self.repaired]


REPORT = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
                    ("repaired_sha256", pa.string()), ("n_rows", pa.int64()), ("n_repaired", pa.int64())])


def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order (an entry, then per segment its audit and its rows) to one row per conversation."""
    done: list[list] = []
    current: Report | None = None

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), REPORT)], schema=REPORT)

    for r in slices(batches):
        if r["seg"] == -1:
            if current:
                done.append(current.result())
            current = Report(r["conv_id"])
            if len(done) >= 1024:
                yield batch()
                done = []
        elif r["pos"] == -1:
            current.segment(r["audit"], r["counts"])
        else:
            current.row(r["turn"], r["role"], r["text"])
    if current:
        done.append(current.result())
    if done:
        yield batch()
