"""Conversation structure repair over a suffix-shared automaton of role and fault signatures.

*Signatures.*  A turn becomes one symbol: its role's initial (s, u, a or another) and its first fault.  Blank: the text
has no character but white space; duplicate: role and text were seen earlier in the conversation; truncated: the last
character but white space is none of ``.!?``.  A conversation is the string of its turns' symbols.

*Automaton.*  Read from the end, conversations share suffixes: a node is a distinct suffix, its one edge leads to
the suffix without its first symbol.  Signatures are sorted by their reversed symbols, so that a node's
conversations follow each other: every node is made once, and is let go when its last conversation has passed, so
that memory holds one path.  The sort may cut a node's conversations at a border of two tasks, each of
which makes the node for itself.  Nodes whose costs differ by one number for all states make the same edits and share
their transitions (``_Register``), as do all nodes whose first symbol only differs in what must be deleted anyhow.

*Costs.*  Grammar states of ``(s?(ua)+)?``: start, after s, after u, after a.  In a node and a state, each
edit leads to one node and one state: Delete (4) to the next node, Insert (3) to the next state of the
same node, Keep (0) and Rerole (3) to both.  Blank and duplicate turns must be deleted; a truncated turn that stays costs
3 more.  As the edits of a choice have different initials, equal costs are decided by the initial, D before I, K and R, and
the best audit of a node and state is its edit followed by the best audit of where that leads.

*At size.*  Symbols are found without texts, with texts named by SHA-256.  Turns are sorted by range, so that a conversation
may lie in many tasks; the pieces of its signature, one character a turn as is the audit it returns, are put together at
the end.  Repairing streams the turns of a conversation, sorted, through one task, a batch at a time, as a
digest of a conversation is sequential.

Defined results: turns go by ``turn``, nulls first, then role, then the SHA-256 of the text; a null role or text is one
space; repeated rows are turns of their own; all turns with a null conv_id are one conversation; roles of other
initials, also empty ones, are deleted or get another role; a conversation without turns has zeros, an empty audit and no repaired turns; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.llm.shared import SPACE, join_hot, stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: where a user or assistant turn leads that is inserted or given its role, and which of both it is
NEXT, SAYS = (AFTER_U, AFTER_U, AFTER_A, AFTER_U), ("user", "user", "assistant", "user")
_INITIALS = "sua"
_FAULTS = ("", "truncated", "blank", "duplicate")
#: a symbol: 4 times the initial's place (3: another) and the fault's place, as a letter from A
_SYMBOLS = "".join(chr(65 + i) for i in range(16))
_GONE = "Z"
_MERGED = "".join(_GONE if i % 4 >= 2 else chr(65 + i) for i in range(16))
_NONE = " "


def _conversation(conv_id: str = "conv_id") -> Column:
    return F.coalesce(F.col(conv_id).cast("string"), F.lit(_NONE))


def _turns(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, print): nulls of role and text are one space."""
    text = F.coalesce(F.col("text"), F.lit(" "))
    return turns.select(_conversation().alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
                        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("print"))


def _order() -> list:
    return ["conv", F.col("turn").asc_nulls_first(), "role", "print"]


def symbols(turns: DataFrame) -> DataFrame:
    """Stage table (conv, turn, role, print, symbol, n): n equal turns at one place, the first of which has ``symbol``, the others are duplicates."""
    blank = ~F.col("text").rlike("[^ \\t-\\r]")
    ends = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1).isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    light = stage(
        _turns(turns).select("conv", "turn", "role", "print", kind.alias("kind"), F.when(blank, 2).when(ends, 0).otherwise(1).alias("fault"))
        .groupBy("conv", "turn", "role", "print", "kind", "fault").agg(F.count("*").alias("n")), "dialogue-turns")
    met = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn"))
    again = stage(light.groupBy("conv", "role", "print").agg(F.count("*").alias("places"), F.min(met).alias("first")).where("places > 1"),
                  "dialogue-repeats")
    marked = join_hot(light, again, ["conv", "role", "print"], "places", "left")
    fault = F.when((F.col("fault") != 2) & F.col("first").isNotNull() & (met != F.col("first")), 3).otherwise(F.col("fault"))
    return stage(marked.select("conv", "turn", "role", "print", (4 * F.col("kind") + fault).cast("int").alias("symbol"), "n"), "dialogue-symbols")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols of neighbouring rows of a conversation as one string."""
    seq = 0
    for batch in batches:
        codes, times = batch.column("symbol").to_numpy(), batch.column("n").to_numpy()
        rest = np.where(codes % 4 == 2, codes, codes // 4 * 4 + 3)
        # the first of equal turns, then its copies
        each = np.repeat(np.arange(len(codes)), times)
        lead = np.zeros(len(each), bool)
        lead[np.cumsum(times) - times] = True
        text = np.where(lead, codes[each], rest[each]).astype(np.uint8) + 65
        convs = batch.column("conv")
        names = convs.dictionary_encode().indices.to_numpy()
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(names)) + 1, [len(names)]))
        ends = np.concatenate(([0], np.cumsum(times)))[cuts]
        made = [text[a:b].tobytes().decode("ascii") for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([
            convs.take(pa.array(cuts[:-1])), batch.column("part").take(pa.array(cuts[:-1])),
            pa.array(np.arange(seq, seq + len(made))), pa.array(made, pa.string())], ["conv", "part", "seq", "symbols"])
        seq += len(made)


def signatures(found: DataFrame) -> DataFrame:
    """(conv, signature, gaps) of the table of ``symbols``."""
    ordered = (found.repartitionByRange(*_order()).sortWithinPartitions(*_order())
               .select("conv", "symbol", "n", F.spark_partition_id().alias("part")))
    pieces = ordered.mapInArrow(_pieces, "conv string, part int, seq long, symbols string")
    whole = pieces.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("part", "seq", "symbols"))).alias("p"))
    whole = whole.select("conv", F.array_join("p.symbols", "").alias("signature"))
    span = (found.where("turn is not null").select("conv", "turn").distinct().groupBy("conv")
            .agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    return whole.join(span, "conv", "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("long"))


class _Register:
    """Kinds of nodes: costs of the four states less the least of them, with the transitions between kinds."""

    def __init__(self):
        self.kinds: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.steps: dict[tuple[int, int], tuple[int, int, int]] = {}
        self.edits: list[tuple] = []
        self.edit_number: dict[tuple, int] = {}
        # the end: accepted at the start and after an assistant; else the missing turns are inserted
        self.end = self._kind((0, 2 * INSERT, INSERT, 0))
        self.end_edits = self._edits(("", "I", "I", ""))

    def _kind(self, costs: tuple) -> int:
        if costs not in self.number:
            self.number[costs] = len(self.kinds)
            self.kinds.append(costs)
        return self.number[costs]

    def _edits(self, edits: tuple) -> int:
        if edits not in self.edit_number:
            self.edit_number[edits] = len(self.edits)
            self.edits.append(edits)
        return self.edit_number[edits]

    def step(self, kind: int, symbol: int) -> tuple[int, int, int]:
        """(kind, added cost, edits) of the node that ``symbol`` leads from to a node of ``kind``."""
        made = self.steps.get((kind, symbol))
        if made is None:
            made = self.steps[kind, symbol] = self._step(self.kinds[kind], symbol)
        return made

    def _step(self, onward: tuple, symbol: int) -> tuple[int, int, int]:
        best = []
        for state in range(4):
            choices = [(DELETE + onward[state], "D")]
            if symbol != ord(_GONE):
                initial, fault = divmod(symbol - 65, 4)
                more = TRUNCATED if fault == 1 else 0
                choices.append((REROLE + more + onward[NEXT[state]], "R"))
                if initial == 0 and state == START:
                    choices.append((KEEP + more + onward[AFTER_S], "K"))
                if initial in (1, 2) and SAYS[state][0] == _INITIALS[initial]:
                    choices.append((KEEP + more + onward[NEXT[state]], "K"))
            best.append(min(choices))
        for _ in range(3):  # insertions: after three the states come round
            best = [min(own, (INSERT + best[NEXT[state]][0], "I")) for state, own in enumerate(best)]
        least = min(cost for cost, _ in best)
        return self._kind(tuple(cost - least for cost, _ in best)), least, self._edits(tuple(edit for _, edit in best))


class SuffixAutomaton:
    """The path of nodes from the end to the signature read last; signatures come sorted from their ends."""

    def __init__(self):
        self.register = _Register()
        self.path = np.zeros(0, np.uint8)
        self.kind = array("l", [self.register.end])
        self.cost = array("q", [0])
        self.edits = array("l", [self.register.end_edits])
        self.made = 0

    def read(self, reversed_signature: bytes) -> tuple[int, str]:
        """(cost, audit) of a signature given from its end; nodes shared with the one before are not made again."""
        path = np.frombuffer(reversed_signature, np.uint8)
        most = min(len(path), len(self.path))
        differ = np.flatnonzero(path[:most] != self.path[:most])
        shared = int(differ[0]) if len(differ) else most
        for own in (self.kind, self.cost, self.edits):
            del own[shared + 1:]
        kind, cost, step = self.kind[shared], self.cost[shared], self.register.step
        for symbol in path[shared:].tolist():
            kind, added, edits = step(kind, symbol)
            cost += added
            self.kind.append(kind)
            self.cost.append(cost)
            self.edits.append(edits)
        self.made += len(path) - shared
        self.path = path
        return cost + self.register.kinds[kind][START], self._audit(path)

    def _audit(self, path: np.ndarray) -> str:
        symbols, state, out, edits, known = path.tolist(), START, [], self.edits, self.register.edits
        at = len(symbols)
        while True:
            edit = known[edits[at]][state]
            if not edit:
                return "".join(out)
            out.append(edit)
            if edit != "D":
                kept_s = edit == "K" and symbols[at - 1] - 65 < 4
                state = AFTER_S if kept_s else NEXT[state]
            if edit != "I":
                at -= 1


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = SuffixAutomaton()
    legal = np.zeros((4, 4), bool)
    legal[[0, 1, 2], [1, 2, 1]] = True
    for batch in batches:
        costs, audits, counts = [], [], []
        for signature, backwards in zip(batch.column("signature").to_pylist(), batch.column("backwards").to_pylist()):
            cost, audit = automaton.read(backwards.encode("ascii"))
            codes = np.frombuffer(signature.encode("ascii"), np.uint8) - 65
            faults, initials = np.bincount(codes % 4, minlength=4), codes // 4
            costs.append(cost)
            audits.append(audit)
            counts.append((faults[2], faults[3], faults[1], int((~legal[initials[:-1], initials[1:]]).sum())))
        columns = np.array(counts, np.int64).reshape(-1, 4).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("gaps"), *(pa.array(c) for c in columns), pa.array(costs, pa.int64()), pa.array(audits, pa.string())],
            ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"])


_AUDIT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(turns: DataFrame) -> DataFrame:
    """Stage table (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), one row for each conversation of ``turns``."""
    signed = stage(signatures(symbols(turns)), "dialogue-signatures")
    backwards = signed.withColumn("backwards", F.reverse(F.translate("signature", _SYMBOLS, _MERGED)))
    # the range is of the last symbols and, among equal ones, of the conversations: a frequent signature is no single task's
    ranged = backwards.repartitionByRange(F.substring("backwards", 1, 64), F.xxhash64("conv"))
    return stage(ranged.sortWithinPartitions("backwards").mapInArrow(_solve, _AUDIT), "dialogue-audits")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams conversations, the row with the audit before its turns: the repaired turns."""
    conv, audit, at, state, pos = None, "", 0, START, 0
    out: list[tuple] = []

    def insert() -> None:
        nonlocal at, state, pos
        while at < len(audit) and audit[at] == "I":
            out.append((conv, pos, SAYS[state], "", "I"))
            at, state, pos = at + 1, NEXT[state], pos + 1

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()))],
            ["conv", "pos", "role", "text", "edit"])
        out.clear()
        return made

    for batch in batches:
        for own, lead, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text"))):
            if lead is not None:
                insert()
                conv, audit, at, state, pos = own, lead, 0, START, 0
                continue
            insert()
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            if edit == "R":
                role = SAYS[state]
            state, pos = (AFTER_S if edit == "K" and role[0] == "s" else NEXT[state]), pos + 1
            out.append((conv, pos - 1, role, text, edit))
        if out:
            yield flush()
    insert()
    if out:
        yield flush()


def repaired(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """(conv, pos, role, text, edit): the turns that ``audits`` leave, each conversation's together and in order."""
    rows = _turns(turns).select("conv", F.lit(None).cast("string").alias("audit"), "turn", "role", "print", "text")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("print", "binary"), ("text", "string"))]
    led = audited.select("conv", "audit", *none).union(rows)
    ordered = led.repartition("conv").sortWithinPartitions("conv", F.col("audit").isNull(), *_order()[1:])
    return ordered.select("conv", "audit", "role", "text").mapInArrow(_apply, "conv string, pos long, role string, text string, edit string")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, sha = None, None
    for batch in batches:
        done = []
        for own, pos, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "pos", "role", "text"))):
            if pos == 0:
                if sha is not None:
                    done.append((conv, sha.hexdigest()))
                conv, sha = own, hashlib.sha256()
            else:
                sha.update(b"\n")
            sha.update(f"{role}:{text}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], pa.string()) for k in (0, 1)], ["conv", "repaired_sha256"])
    if sha is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([sha.hexdigest()])], ["conv", "repaired_sha256"])


def digests(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: counts of faults, cost, audit, and the SHA-256 of the repaired ``role:text`` lines."""
    audited = audits(turns)
    hashed = repaired(turns, audited).mapInArrow(_digest, "conv string, repaired_sha256 string")
    kind = conversations.schema["conv_id"].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        conversations.select(_conversation().alias("conv")).distinct().join(audited, "conv", "left").join(hashed, "conv", "left")
        .select(F.when(F.col("conv") != _NONE, F.col("conv")).cast(kind).alias("conv_id"),
                *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
                F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
    )
