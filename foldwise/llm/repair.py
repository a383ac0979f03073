r"""Conversation structure repair: the cheapest edits that turn the roles into ``(system? (user assistant)+)?``.

Each row has a role class (system, user, assistant by its initial, else other) and a first fault: blank (no character but
``[\x20\x09-\x0D]``), duplicate (role and text seen earlier in the conversation), truncated (last such character not ``[.!?]``).
Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (the only edit of blank and duplicate rows), Insert an empty user or
assistant row 3; a truncated row that isn't deleted costs 3 more.  Of equally cheap edit strings (initials D, I, K, R in order)
the least is taken.  What role an edit gives follows from the state: start, after system, after user, after assistant.

Method, a dynamic program on a grammar:

1. Rows become one symbol each (role class x fault); rows are dealt out by range of (conversation, order) and cut into segments of up to
   ``segment`` symbols, so a long conversation spreads over tasks.  Equal segments are one *sequence* from here on.
2. Re-Pair over all distinct sequences: each round counts adjacent symbols by a distributed sum and replaces the most frequent pairs
   (which do not overlap each other) by new symbols, until none occurs twice or ``rounds`` are over.  What is left unpaired only
   means a longer product below.
3. A symbol has one min-plus transfer matrix over the four states, that of a rule the product of its two.  An entry is a cost and an audit
   rope: the middle state, i.e. the two shorter ropes.  Texts of ropes are never compared: two cheapest edit strings of equal rows
   and equal start state end in different states or are the same, and neither begins the other (its surplus would be Inserts that
   cost more), so the order of two products follows from the rank of their left halves.  A matrix is 4 x 4 costs,
   middles and ranks at any length.
4. Each conversation multiplies its segments' matrices, which fixes the entry and exit state of each; every distinct (sequence, entry, exit)
   is unrolled once, and the edits meet their rows again in one sorted pass over (conversation, order).

That pass, like the digest of a whole conversation, is a chain in the order of its rows: it holds one batch of rows at a time.

Edge cases: null roles and texts are one space (a null text is blank); null turns come first; rows of equal turn are ordered by role,
then MD5 of the text; repeated rows are duplicates; an empty text is blank; a null conversation id is a conversation; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import staged

ROLES, FAULTS = "sua", ("", "blank", "duplicate", "truncated")
BLANKS = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
#: state that follows from a role's initial, and the role that Rerole or Insert gives in a state
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
GIVES = {START: (USER, "user"), SYSTEM: (USER, "user"), ASSISTANT: (USER, "user"), USER: (ASSISTANT, "assistant")}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FAR = 1 << 40
N_SYMBOLS = 16


# ---- matrices ------------------------------------------------------------------------------------

class Matrix:
    """cost[i, j], mid[i, j] (middle state of a product), rank[i, j] (order of the edit strings from i by their end j), text (of single symbols)."""

    __slots__ = ("cost", "mid", "rank", "text")

    def __init__(self, cost, rank, mid=None, text=None):
        self.cost, self.rank, self.mid, self.text = cost, rank, mid, text


def inserts(state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, edits) that Inserts alone reach; more than two come back to a state already left."""
    yield state, 0, ""
    one = GIVES[state][0]
    yield one, INSERT, "I"
    yield GIVES[one][0], 2 * INSERT, "II"


def of_symbol(code: int) -> Matrix:
    """Inserts, then one edit of a row with role class code // 4 and fault code % 4."""
    role, fault = (ROLES + "o")[code // 4], FAULTS[code % 4]
    cost, text = np.full((4, 4), FAR), [[""] * 4 for _ in range(4)]
    for i in range(4):
        best: dict[int, tuple[int, str]] = {}
        for k, c, e in inserts(i):
            to = [(k, c + DELETE, e + "D")]
            if fault in ("", "truncated"):
                more = c + (TRUNCATED if fault else 0)
                to.append((GIVES[k][0], more + REROLE, e + "R"))
                if k in NEXT.get(role, {}):
                    to.append((NEXT[role][k], more + KEEP, e + "K"))
            for j, *entry in to:
                best[j] = min(best.get(j, (FAR, "")), tuple(entry))
        for j, (c, e) in best.items():
            cost[i, j], text[i][j] = c, e
    rank = np.array([[sorted(row[j] for j in range(4) if cost[i, j] < FAR).index(row[k]) if cost[i, k] < FAR else 4 for k in range(4)] for i, row in enumerate(text)])
    return Matrix(cost, rank, text=text)


def product(left: Matrix, right: Matrix) -> Matrix:
    cost, mid, rank = np.full((4, 4), FAR), np.zeros((4, 4), np.int8), np.full((4, 4), 4)
    for i in range(4):
        for j in range(4):
            cost[i, j], order, mid[i, j] = min((min(left.cost[i, k] + right.cost[k, j], FAR), left.rank[i, k], k) for k in range(4))
        done = sorted((left.rank[i, mid[i, j]], right.rank[mid[i, j], j], j) for j in range(4) if cost[i, j] < FAR)
        for place, (_, _, j) in enumerate(done):
            rank[i, j] = place
    return Matrix(cost, rank, mid)


#: Inserts behind the last row that end in an accepted state
FINISH = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}


class Grammar:
    """Rules (left, right) of the symbols from ``N_SYMBOLS`` on, by rounds; matrices bottom-up, each rule once."""

    def __init__(self, rounds: list[list[tuple[int, int]]]):
        self.rounds = rounds
        self.rules = [r for new in rounds for r in new]
        self.matrices = [of_symbol(c) for c in range(N_SYMBOLS)]
        for a, b in self.rules:
            self.matrices.append(product(self.matrices[a], self.matrices[b]))
        self._short: dict[tuple[int, int, int], str] = {}

    def compress(self, seqs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All sequences after all rounds: symbols, each sequence followed by -1, and the ends."""
        s = np.frombuffer(b"\xff".join([*seqs, b""]), np.uint8).astype(np.int32)
        s[s == 255] = -1
        first = N_SYMBOLS
        for new in self.rounds:
            s = replace(s, new, first)
            first += len(new)
        return s, np.flatnonzero(s < 0)

    def fold(self, symbols) -> tuple[list[Matrix], Matrix]:
        """Products of the first 1, 2, ... symbols; and the whole."""
        out = [self.matrices[symbols[0]]]
        for x in symbols[1:]:
            out.append(product(out[-1], self.matrices[x]))
        return out, out[-1]

    def unroll(self, symbol: int, i: int, j: int) -> str:
        """The rope of an entry as text; those of short rules are kept."""
        key, m = (symbol, i, j), self.matrices[symbol]
        if m.text is not None:
            return m.text[i][j]
        if key not in self._short:
            a, b = self.rules[symbol - N_SYMBOLS]
            text = self.unroll(a, i, int(m.mid[i, j])) + self.unroll(b, int(m.mid[i, j]), j)
            if len(text) > 256:
                return text
            self._short[key] = text
        return self._short[key]

    def edits(self, symbols, i: int, j: int) -> str:
        """The edits of a sequence from state i to j."""
        products, _ = self.fold(symbols)
        out = []
        for p, x in zip(reversed(products), reversed(symbols), strict=True):
            k = i if p.mid is None or len(out) == len(symbols) - 1 else int(p.mid[i, j])
            out.append(self.unroll(x, k, j))
            j = k
        return "".join(reversed(out))


def replace(s: np.ndarray, rules: list[tuple[int, int]], first: int) -> np.ndarray:
    """Sequences with the pairs of one round replaced by the symbols from ``first`` on; no symbol is the left of one rule and the right of another."""
    if not rules:
        return s
    s = s.copy()
    keep = np.ones(len(s), bool)
    code = {p: first + k for k, p in enumerate(rules)}
    pair = s[:-1].astype(np.int64) << 32 | s[1:].astype(np.int64) & 0xFFFFFFFF
    want = np.array(sorted((a << 32 | b, c) for (a, b), c in code.items()), np.int64).reshape(-1, 2)
    at = np.searchsorted(want[:, 0], pair)
    hit = np.flatnonzero((at < len(want)) & (want[np.minimum(at, len(want) - 1), 0] == pair))
    if len(hit):  # pairs of one symbol overlap in a run: every other one of it counts
        same = s[hit] == s[hit + 1]
        begins = np.concatenate([[True], (np.diff(hit) > 1) | ~(same[1:] & same[:-1])])
        run = np.maximum.accumulate(np.where(begins, np.arange(len(hit)), 0))
        hit = hit[~same | ((np.arange(len(hit)) - run) % 2 == 0)]
    new = want[at[hit], 1]
    s[hit] = new
    keep[hit + 1] = False
    return s[keep]


def disjoint(counted: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs by falling count those of which no symbol is the left of one and the right of another."""
    left, right, out = set(), set(), []
    for a, b in counted:
        if (a not in right and b not in left) if a != b else (a not in left and a not in right):
            left.add(a)
            right.add(b)
            out.append((a, b))
    return out


def grammar(sequences: DataFrame, rounds: int = 12, pairs: int = 256) -> Grammar:
    """Re-Pair rules of all sequences (a staged table of column seq); each round replaces up to ``pairs`` of the most frequent pairs."""
    g = Grammar([])
    for _ in range(rounds):
        def count(batches, g=g):
            for b in batches:
                s, _ = g.compress(b.column("seq").to_pylist())
                ok = (s[:-1] >= 0) & (s[1:] >= 0)
                if ok.any():
                    u, n = np.unique(s[:-1][ok].astype(np.int64) << 32 | s[1:][ok], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(u >> 32), pa.array(u & 0xFFFFFFFF), pa.array(n.astype(np.int64))], ["a", "b", "n"])

        found = sequences.select("seq").mapInArrow(count, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 1")
        top = found.orderBy(F.col("n").desc(), "a", "b").limit(pairs).collect()
        new = disjoint([(r["a"], r["b"]) for r in top])
        if not new:
            break
        g = Grammar([*g.rounds, new])
    return g


# ---- rows to edits -------------------------------------------------------------------------------

def spaced(c: str, kind: str = "string") -> Column:
    return F.coalesce(F.col(c).cast(kind), F.lit(" "))


def symbols(rows: DataFrame) -> DataFrame:
    """conv, turn, role, key, codes (role class x fault of the first of n equal rows), n; rows: conv, turn, role, text."""
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(end == "", 1).when(F.substring(end, -1, 1).isin(".", "!", "?"), 0).otherwise(3)
    r = rows.select("conv", "turn", "role", F.md5(F.col("text").cast("binary")).alias("key"), fault.alias("fault"))
    r = staged(r.groupBy("conv", "turn", "role", "key").agg(F.count("*").alias("n"), F.min("fault").alias("fault")))
    place = F.struct(F.col("turn").isNotNull().alias("given"), "turn")  # null turns come first
    first = r.groupBy(F.col("conv").alias("c"), F.col("role").alias("o"), F.col("key").alias("k")).agg(F.min(place).alias("first"))
    r = r.join(first, F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("o")) & (F.col("key") == F.col("k")))
    late = (F.col("fault") != 1) & ((place["given"] != F.col("first.given")) | ~F.col("turn").eqNullSafe(F.col("first.turn")))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return r.select("conv", "turn", "role", "key", (kind * 4 + F.when(late, 2).otherwise(F.col("fault"))).alias("code"), "n")


def segments(syms: DataFrame, conv: str, turn: str, segment: int) -> DataFrame:
    """conv, turn, role, key, part (place of the first row's copies), seq: runs of up to ``segment`` rows of a conversation in order."""
    def cut(batches):
        head, seq = None, bytearray()
        for b in batches:
            out = []
            for row in zip(*(b.column(c).to_pylist() for c in ("conv", "turn", "role", "key", "code", "n")), strict=True):
                c, code, left = row[0], row[4], row[5]
                done, more = 0, code if code % 4 == 1 else code // 4 * 4 + 2  # further equal rows are duplicates, unless blank
                while left:
                    if head is None or head[0] != c or len(seq) >= segment:
                        if head is not None:
                            out.append((*head, bytes(seq)))
                        head, seq = (*row[:4], done), bytearray()
                    take = min(left, segment - len(seq))
                    seq += bytes([code if not done else more]) + bytes([more]) * (take - 1)
                    done, left = done + take, left - take
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
        if head is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*head, bytes(seq)), types, strict=True)], names)

    names = ["conv", "turn", "role", "key", "part", "seq"]
    kinds = [syms.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    types = [_arrow(kinds[0]), _arrow(kinds[1]), pa.string(), pa.string(), pa.int64(), pa.binary()]
    n = int(syms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return syms.repartitionByRange(n, "conv", "turn", "role", "key").sortWithinPartitions("conv", "turn", "role", "key").mapInArrow(
        cut, f"conv {kinds[0]}, turn {kinds[1]}, role string, key string, part long, seq binary")


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_type(_parse_datatype_string(kind))


def _few(df: DataFrame, seq: str, max_bytes: int = 32 << 20) -> DataFrame:
    """A staged table with a broadcast hint if its bytes are counted to be few; else the join is a shuffle that adaptive execution splits."""
    return F.broadcast(df) if (df.agg(F.sum(F.octet_length(seq) + 200)).first()[0] or 0) <= max_bytes else df


def edits(rows: DataFrame, segment: int = 4096, rounds: int = 12) -> DataFrame:
    """conv, turn, role, key, part, seq, edits: the cheapest edits of each segment, in the order of its rows; rows: conv, turn, role, text."""
    segs = staged(segments(symbols(rows), "conv", "turn", segment))
    seqs = staged(segs.groupBy("seq").agg(F.count("*").alias("uses")))
    shared = rows.sparkSession.sparkContext.broadcast(grammar(seqs, rounds))

    def transfer(batches):
        for b in batches:
            g, data = shared.value, b.column("seq").to_pylist()
            s, ends = g.compress(data)
            whole = [g.fold(s[a:e])[1] for a, e in zip(np.concatenate([[0], ends[:-1] + 1]), ends, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("seq"), pa.array([m.cost.astype("<i8").tobytes() for m in whole], pa.binary()), pa.array([m.rank.astype("i1").tobytes() for m in whole], pa.binary())], ["seq", "cost", "rank"])

    matrices = staged(seqs.select("seq").mapInArrow(transfer, "seq binary, cost binary, rank binary"))
    order = ["conv", "turn", "role", "key", "part"]
    kinds = ", ".join(f"{c} {segs.schema[c].dataType.simpleString()}" for c in order)

    def paths(batches):
        held: list[tuple] = []
        for b in batches:
            out = []
            for row in zip(*(b.column(c).to_pylist() for c in (*order, "seq", "cost", "rank")), strict=True):
                if held and held[0][0] != row[0]:
                    out += _route(held)
                    held = []
                held.append(row)
            if out:
                yield _batch(out)
        if held:
            yield _batch(_route(held))

    names = [*order, "seq", "entry", "exit", "last"]
    types = [_arrow(segs.schema[c].dataType.simpleString()) for c in order] + [pa.binary(), pa.int32(), pa.int32(), pa.bool_()]
    _batch = lambda out: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
    routed = staged(segs.join(_few(matrices, "seq"), "seq").select(*order, "seq", "cost", "rank").repartition("conv").sortWithinPartitions(*order)
                    .mapInArrow(paths, f"{kinds}, seq binary, entry int, exit int, last boolean"))

    def unroll(batches):
        for b in batches:
            g = shared.value
            s, ends = g.compress(b.column("seq").to_pylist())
            begin = np.concatenate([[0], ends[:-1] + 1])
            text = [g.edits(s[a:e], i, j) for a, e, i, j in zip(begin, ends, b.column("entry").to_pylist(), b.column("exit").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(text, pa.string())], ["seq", "entry", "exit", "edits"])

    unrolled = staged(routed.select("seq", "entry", "exit").distinct().mapInArrow(unroll, "seq binary, entry int, exit int, edits string"))
    tail = F.element_at(F.array(*[F.lit(FINISH[k][1]) for k in range(4)]), F.col("exit") + 1)
    return routed.join(_few(unrolled, "seq"), ["seq", "entry", "exit"]).select(*order, "seq", F.concat("edits", F.when(F.col("last"), tail).otherwise("")).alias("edits"))


def _route(held: list[tuple]) -> list[tuple]:
    """The segments of one conversation with their entry and exit states on the cheapest path."""
    ms = [Matrix(np.frombuffer(r[6], "<i8").reshape(4, 4), np.frombuffer(r[7], "i1").reshape(4, 4).astype(int)) for r in held]
    whole = [ms[0]]
    for m in ms[1:]:
        whole.append(product(whole[-1], m))
    end = min(range(4), key=lambda j: (whole[-1].cost[START, j] + FINISH[j][0], whole[-1].rank[START, j]))
    out = []
    for k in range(len(held) - 1, -1, -1):
        entry = int(whole[k].mid[START, end]) if k else START
        out.append((*held[k][:6], entry, end, k == len(held) - 1))
        end = entry
    return out[::-1]


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = 4096, rounds: int = 12) -> DataFrame:
    """The edit script: conv_id, turn, edit (K, R, D, I), fault, given (role before), role and text after (null if deleted); an inserted row
    has no turn, fault or given role.

    One row per edit; conversations lie whole and in order within partitions."""
    r = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"))
    found = edits(r, segment, rounds)
    kinds = [r.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    none = F.lit(None)
    both = r.select("conv", "turn", "role", F.md5(F.col("text").cast("binary")).alias("key"), F.lit(1).alias("kind"), none.cast("long").alias("part"), "text", none.cast("binary").alias("seq"), none.cast("string").alias("edits")) \
        .unionByName(found.select("conv", "turn", "role", "key", F.lit(0).alias("kind"), "part", none.cast("string").alias("text"), "seq", "edits"))
    names = ["conv_id", "turn", "edit", "fault", "given", "role", "text"]
    types = [_arrow(kinds[0]), _arrow(kinds[1]), *[pa.string()] * 5]

    def script(batches):
        state = {"conv": None, "open": False, "state": START, "edits": "", "at": 0, "seq": b"", "row": 0}

        def apply(out, row=None):
            """The edits up to and with that of the row; at a conversation's end those that are left."""
            while state["at"] < len(state["edits"]):
                e = state["edits"][state["at"]]
                state["at"] += 1
                if e == "I":
                    state["state"], role = GIVES[state["state"]]
                    out.append((state["conv"], None, "I", None, None, role, ""))
                    continue
                turn, role, text = row
                fault = FAULTS[state["seq"][state["row"]] % 4]
                state["row"] += 1
                after = role
                if e == "R":
                    state["state"], after = GIVES[state["state"]]
                elif e == "K":
                    state["state"] = NEXT[role[0]][state["state"]]
                out.append((state["conv"], turn, e, fault, role, *((None, None) if e == "D" else (after, text))))
                return

        for b in batches:
            out: list[tuple] = []
            for c, t, o, kind, x, seq, e in zip(*(b.column(k).to_pylist() for k in ("conv", "turn", "role", "kind", "text", "seq", "edits")), strict=True):
                if not state["open"] or c != state["conv"]:
                    if state["open"]:
                        apply(out)
                    state.update(conv=c, open=True, state=START, edits="", at=0, seq=b"", row=0)
                if kind:
                    apply(out, (t, o, x))
                else:  # what is used up goes
                    state.update(edits=state["edits"][state["at"] :] + e, at=0, seq=state["seq"][state["row"] :] + seq, row=0)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), types, strict=True)], names)
        out = []
        if state["open"]:
            apply(out)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out, strict=True), types, strict=True)], names)

    return both.repartition("conv").sortWithinPartitions("conv", "turn", "role", "key", "kind", "part").mapInArrow(
        script, f"conv_id {kinds[0]}, turn {kinds[1]}, edit string, fault string, given string, role string, text string")


# ---- report --------------------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given to the user by crc32 of ``conv_id:turn`` modulo 20; nulls are one space."""
    k = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    r = conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), k.alias("k")).filter("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return r.select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                    F.explode(F.when(F.col("k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def summary(script: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of the edit scripts of ``repair``."""
    kind = script.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [_arrow(kind), *[pa.int64()] * 6, pa.string(), pa.string()]
    price = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def run(batches):
        now = None

        def done():
            first, last, turns = now["turns"]
            gaps = last - first + 1 - turns if turns else 0
            return (now["conv"], gaps, *(now[f] for f in FAULTS[1:]), now["illegal"], now["cost"], "".join(now["audit"]), now["hash"].hexdigest())

        for b in batches:
            out = []
            for c, turn, edit, fault, given, role, text in zip(*(b.column(k).to_pylist() for k in ("conv_id", "turn", "edit", "fault", "given", "role", "text")), strict=True):
                if now is None or now["conv"] != c:
                    if now is not None:
                        out.append(done())
                    now = {"conv": c, "turns": (0, 0, 0), "illegal": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "any": False, "before": None} | dict.fromkeys(FAULTS[1:], 0)
                now["audit"].append(edit)
                now["cost"] += price[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if edit != "I":
                    if fault:
                        now[fault] += 1
                    now["illegal"] += now["before"] is not None and (now["before"], given[:1]) not in LEGAL
                    now["before"] = given[:1]
                    if turn is not None:
                        first, last, n = now["turns"]
                        now["turns"] = (first, turn, n + (turn != last)) if n else (turn, turn, 1)
                if edit != "D":
                    now["hash"].update((("\n" if now["any"] else "") + f"{role}:{text}").encode())
                    now["any"] = True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(done(), types, strict=True)], names)

    return script.mapInArrow(run, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def report(conversations: DataFrame) -> DataFrame:
    """The summary of every conversation after damage; one of which no row is left has zeros, no edits and the digest of an empty text."""
    found = summary(repair(damage(conversations))).withColumnRenamed("conv_id", "c")
    every = conversations.select("conv_id").distinct()
    none = hashlib.sha256().hexdigest()
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *[F.coalesce(x, F.lit(0).cast("long")).alias(x) for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))


REPORT_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS tab),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS k FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy_ FROM k WHERE k <> 0),
o AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended, row_number() OVER w AS pos, left(role, 1) AS ini,
  lag(left(role, 1)) OVER w AS ini0 FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text))),
r AS (SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
ins(i, k, c, e) AS (VALUES (0,0,0,''),(0,2,3,'I'),(0,3,6,'II'),(1,1,0,''),(1,2,3,'I'),(1,3,6,'II'),(2,2,0,''),(2,3,3,'I'),(2,2,6,'II'),(3,3,0,''),(3,2,3,'I'),(3,3,6,'II')),
keep(ini, k, j) AS (VALUES ('s',0,1),('u',0,2),('u',1,2),('u',3,2),('a',2,3)),
step_ AS (SELECT i, k, k AS j, c + 4 AS c, e || 'D' AS e, NULL::VARCHAR AS ini, true AS del FROM ins UNION ALL SELECT i, k, CASE WHEN k = 2 THEN 3 ELSE 2 END, c + 3, e || 'R', NULL::VARCHAR, false FROM ins
  UNION ALL SELECT ins.i, ins.k, keep.j, ins.c, ins.e || 'K', keep.ini, false FROM ins JOIN keep ON ins.k = keep.k),
last_ AS (SELECT conv_id, max(pos) AS n FROM r GROUP BY conv_id),
dp(conv_id, pos, st, best) AS (SELECT conv_id, 0::BIGINT, 0, {'c': 0, 'e': ''} FROM last_
  UNION ALL SELECT dp.conv_id, r.pos, s.j, min({'c': dp.best.c + s.c + CASE WHEN r.fault = 'truncated' AND NOT s.del THEN 3 ELSE 0 END, 'e': dp.best.e || s.e})
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.pos = dp.pos + 1 JOIN step_ s ON s.i = dp.st AND (s.del OR r.fault NOT IN ('blank', 'duplicate')) AND (s.ini IS NULL OR s.ini = r.ini) GROUP BY dp.conv_id, r.pos, s.j),
fin AS (SELECT dp.conv_id, min({'c': best.c + f.c, 'e': best.e || f.e}) AS best FROM dp JOIN last_ ON last_.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.pos = last_.n JOIN (VALUES (0,0,''),(1,6,'II'),(2,3,'I'),(3,0,'')) f(st, c, e) ON f.st = dp.st GROUP BY dp.conv_id),
ed AS (SELECT conv_id, unnest(string_split(best.e, '')) AS e, generate_subscripts(string_split(best.e, ''), 1) AS p FROM fin WHERE best.e <> ''),
ed2 AS (SELECT *, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY p) AS pos, count(*) FILTER (e IN ('I', 'R')) OVER (PARTITION BY conv_id ORDER BY p) AS made FROM ed),
kept AS (SELECT ed2.conv_id, p, e, CASE WHEN e = 'I' THEN NULL ELSE role END AS given, CASE WHEN e = 'I' THEN '' ELSE text END AS text,
  row_number() OVER (PARTITION BY ed2.conv_id ORDER BY p) AS q FROM ed2 LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM ed2.conv_id AND r.pos = ed2.pos WHERE e <> 'D'),
sys AS (SELECT conv_id, max(CASE WHEN q = 1 AND e = 'K' AND left(given, 1) = 's' THEN 1 ELSE 0 END) AS s FROM kept GROUP BY conv_id),
txt AS (SELECT kept.conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN given WHEN (q - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY p)) AS h FROM kept JOIN sys ON sys.conv_id IS NOT DISTINCT FROM kept.conv_id GROUP BY kept.conv_id),
agg AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pos > 1 AND ini0 || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.e, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN agg ON agg.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN fin ON fin.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN txt ON txt.conv_id IS NOT DISTINCT FROM c.conv_id
"""
