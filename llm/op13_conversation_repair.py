"""Repair of conversations: cheapest edits to a sequence of turns that the grammar ``(s?(ua)+)?`` accepts.

Approximate matching of a regular expression in layers of cost, after Wu and Manber. Between two turns, bit s of
layer c says that from grammar state s the turns that follow can be repaired at cost c. A turn's layers come from
those of the turn after it, all at once: keeping a turn shifts by no layer, roling it anew or inserting a turn by
three, deleting it by four. The first layer with the start state is the cost; a walk along the bits, at each
step by the least letter that still ends at that cost, gives the least audit. The states' costs at a turn differ by
under ``BAND`` layers (each state can stand in for another by an insertion or two, or by deleting a turn kept as s), so
the layers of a turn are one 64-bit word above a base, and as there are few different words, steps are looked up.

Rows are damaged and judged by column functions; which rows repeat earlier ones is found by a window over
digests. Each conversation then streams through a task twice, sorted: first its turns without their texts, which give
the edits, then the texts, which are hashed as they come. A task holds some 20 bytes for each turn of its
longest conversation, and no text but a batch's. A conversation cannot be dealt to several tasks: the hash of its text is a
chain over all of it.

Defined cases: a null conv_id, turn, role or text counts as one space in what is hashed and judged; a null conv_id is a conversation
of its own and is returned as null; turns that tie go by role and then by digest of the text, so repeated rows lie side by side; a
row that repeats an earlier one's role and text counts as blank if it is blank, else as duplicate; roles but their
first character do not matter to the grammar; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.tables import in_batches, shuffles, table

#: Costs of edits, and what a truncated turn adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Grammar states: nothing yet, after s, after u, after a; the first and last accept.
STATES, START, ACCEPTING = 4, 0, (0, 3)
#: Where each initial leads from each state, -1 for nowhere.
NEXT = {"s": (1, -1, -1, -1), "u": (2, 2, -1, 2), "a": (-1, -1, 3, -1)}
INITIALS = "sua"
NAMES = {"u": "user", "a": "assistant"}
#: Layers of a word.
BAND = 16
#: A turn as one byte: its initial (3 for any other), plus 4 if it has to go, plus 8 if it is truncated.
GONE, CUT = 4, 8
WHITE = " \t\n\u000b\f\r"
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def emitted(word: int, initial: str) -> int:
    """Layers from which emitting ``initial`` leads to the layers of ``word``."""
    out = 0
    for state, to in enumerate(NEXT[initial]):
        if to >= 0:
            out |= (word >> to & 0x1111111111111111) << state
    return out


def inserted(word: int) -> int:
    """``word`` with what insertions add: three lead through all states."""
    for _ in range(3):
        word |= (emitted(word, "u") | emitted(word, "a")) << STATES * INSERT
        word &= (1 << STATES * BAND) - 1
    return word


@lru_cache(maxsize=1 << 16)
def before(word: int, turn: int) -> tuple[int, int]:
    """(layers, how many are dropped below them) before a turn, from those after it."""
    out = word << STATES * DELETE
    if not turn & GONE:
        extra = TRUNCATED if turn & CUT else 0
        if turn & 3 < len(INITIALS):
            out |= emitted(word, INITIALS[turn & 3]) << STATES * extra
        out |= (emitted(word, "u") | emitted(word, "a")) << STATES * (REROLE + extra)
    empty = ((out & -out).bit_length() - 1) // STATES
    return inserted(out >> STATES * empty & (1 << STATES * BAND) - 1), empty


END = inserted(sum(1 << s for s in ACCEPTING))


def layers(turns: bytes) -> tuple[array, array]:
    """(word, cost of its lowest layer) at each place between turns, from the last to the first."""
    words, bases = array("Q", [END]), array("q", [0])
    word, base = END, 0
    for turn in reversed(turns):
        word, empty = before(word, turn)
        base += empty
        words.append(word)
        bases.append(base)
    return words, bases


def repair(turns: bytes) -> tuple[int, str]:
    """(least cost, least audit of that cost) of turns given as bytes."""
    words, bases = layers(turns)
    n = len(turns)

    def costs(at: int, state: int, cost: int) -> bool:
        layer = cost - bases[n - at]
        return 0 <= layer < BAND and bool(words[n - at] >> STATES * layer + state & 1)

    state, at = START, 0
    cost = least = next(c for c in range(bases[n], bases[n] + BAND) if costs(0, START, c))
    audit = []
    while at < n or cost:
        turn = turns[at] if at < n else GONE
        extra = TRUNCATED if turn & CUT else 0
        role = "a" if state == 2 else "u"  # what a turn that is inserted or roled anew has to be here
        keep = NEXT[INITIALS[turn & 3]][state] if turn & 3 < len(INITIALS) else -1
        if at < n and costs(at + 1, state, cost - DELETE):
            letter, cost, at = "D", cost - DELETE, at + 1
        elif costs(at, NEXT[role][state], cost - INSERT):
            letter, cost, state = "I", cost - INSERT, NEXT[role][state]
        elif not turn & GONE and keep >= 0 and costs(at + 1, keep, cost - extra):
            letter, cost, at, state = "K", cost - extra, at + 1, keep
        else:
            letter, cost, at, state = "R", cost - REROLE - extra, at + 1, NEXT[role][state]
        audit.append(letter)
    return least, "".join(audit)


repaired_often = lru_cache(maxsize=1 << 14)(repair)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that each row's crc32 deals it; a row that is dropped has ``there`` false."""
    blank = F.lit(" ")
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    deal = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), text_of("role").alias("role"), text_of("text").alias("text"), deal.alias("deal"))
    text = F.when(F.col("deal") == 1, "").when(F.col("deal") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("deal") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("deal") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("deal") != 0).alias("there"), times.alias("copy")).drop("copy")


def initial() -> Column:
    first = F.substring("role", 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def judged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns without texts, turns with theirs), both with what sorts them: conv_id, turn, role, digest.

    ``code`` is the turn's byte, plus 16 if it is blank and 32 if it repeats an earlier one; null if the row was dropped.
    """
    body = F.rtrim("text", F.lit(WHITE))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    blank = body == ""
    cut = ~F.substring(body, -1, 1).isin(".", "!", "?")
    facts = rows.select("conv_id", "turn", "role", "digest", "there", initial().alias("initial"), blank.alias("blank"), cut.alias("cut"))
    same = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    solid = facts.where("there and not blank").withColumn("again", F.row_number().over(same) > 1)
    facts = solid.unionByName(facts.where("not there or blank").withColumn("again", F.lit(False)))
    code = F.col("initial") + F.when(F.col("blank"), GONE + 16).when(F.col("again"), GONE + 32).when(F.col("cut"), CUT).otherwise(0)
    turns = facts.select("conv_id", "turn", "role", "digest", F.when(F.col("there"), code).cast("int").alias("code"))
    return turns, rows.where("there").select("conv_id", "turn", "role", "digest", "text")


@dataclass
class Conversation:
    """What a task knows of the conversation that streams through it."""

    codes: list[np.ndarray] = field(default_factory=list)
    low: int | None = None
    high: int | None = None
    distinct: int = 0
    edits: str | None = None
    cost: int = 0
    facts: tuple = (0, 0, 0, 0)
    at: int = 0
    state: int = START
    wrote: bool = False
    hash: object = field(default_factory=hashlib.sha256)

    def turns(self, code: np.ndarray, turn: pa.Array) -> None:
        """Some of its turns without texts, in order; code -1 is a row that was dropped."""
        there = code >= 0
        self.codes.append(code[there].astype(np.uint8))
        values = turn.filter(pa.array(there)).drop_null().to_numpy()
        if len(values):
            steps = int((values[1:] != values[:-1]).sum()) + (self.high is None or int(values[0]) != self.high)
            self.low = int(values[0]) if self.low is None else self.low
            self.high, self.distinct = int(values[-1]), self.distinct + steps

    def decide(self) -> None:
        """The edits, once all turns are known."""
        if self.edits is not None:
            return
        code = np.concatenate([np.empty(0, dtype=np.uint8), *self.codes])
        self.codes = []
        legal = np.zeros((4, 4), dtype=bool)
        for pair in ("su", "ua", "au"):
            legal[INITIALS.index(pair[0]), INITIALS.index(pair[1])] = True
        first = code & 3
        illegal = int((~legal[first[:-1], first[1:]]).sum()) if len(code) else 0
        kind = [int((code & bit > 0).sum()) for bit in (16, 32, CUT)]
        self.facts = (*kind, illegal)
        turns = (code & 15).tobytes()
        self.cost, self.edits = repaired_often(turns) if len(turns) <= 64 else repair(turns)

    def write(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.wrote else "") + role + ":" + text).encode())
        self.wrote = True

    def insertions(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            role = "a" if self.state == 2 else "u"
            self.write(NAMES[role], "")
            self.state, self.at = NEXT[role][self.state], self.at + 1

    def text(self, role: str, text: str) -> None:
        """The next of its turns with its text."""
        self.decide()
        self.insertions()
        letter, self.at = self.edits[self.at], self.at + 1
        if letter == "D":
            return
        first = role[:1]
        if letter == "R":
            first = "a" if self.state == 2 else "u"
            role = NAMES[first]
        self.state = NEXT[first][self.state]
        self.write(role, text)

    def result(self) -> tuple:
        self.decide()
        self.insertions()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return gaps, *self.facts, self.cost, self.edits, self.hash.hexdigest()


def repaired(conversations: DataFrame) -> DataFrame:
    """A row for each conversation of rows (conv_id, turn, role, text, there): its faults, the least cost, the edits and the repaired text's hash."""
    turns, texts = judged(conversations)
    order = ["conv_id", "kind", F.asc_nulls_first("turn"), "role", "digest", "code"]  # of equal rows the one that counts as repeated comes last
    both = turns.withColumns({"kind": F.lit(0), "text": F.lit(None).cast("string")})
    both = both.unionByName(texts.withColumns({"kind": F.lit(1), "code": F.lit(None).cast("int")}))
    rows = both.repartition(shuffles(conversations.sparkSession), "conv_id").sortWithinPartitions(*order)
    made = T._parse_datatype_string(RESULT)
    schema = T.StructType([conversations.schema["conv_id"], *made.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out, current, now = [], [], None, None

        def done() -> pa.RecordBatch:
            columns = [ids, *zip(*out, strict=True)]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=schema.names)
            ids.clear()
            out.clear()
            return batch

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.column(0).type, *[pa.int64()] * 6, pa.string(), pa.string()]
            names = batch.column(0).to_pylist()
            kind = batch.column(1).to_numpy()
            code = batch.column(3).fill_null(-1).to_numpy()
            roles, texts = batch.column(4), batch.column(5)
            starts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1] or kind[i] != kind[i - 1]), len(names)]
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                if current is None or names[a] != now:
                    if current is not None:
                        ids.append(now)
                        out.append(current.result())
                    current, now = Conversation(), names[a]
                if kind[a] == 0:
                    current.turns(code[a:b], batch.column(2).slice(a, b - a))
                else:
                    for role, text in zip(roles.slice(a, b - a).to_pylist(), texts.slice(a, b - a).to_pylist(), strict=True):
                        current.text(role, text)
            if len(ids) > 4096:
                yield done()
        if current is not None:
            ids.append(now)
            out.append(current.result())
            yield done()

    return in_batches(rows.select("conv_id", "kind", "turn", "code", "role", "text"), run, schema)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))
