"""Transcript parsing with a hidden Markov model, and canonical turns.

A transcript is plain lines in which speakers are marked in many styles, or not
at all. Every line becomes a few categorical features: the kind of its marker,
its length, how it ends, and whether a blank line stands before it. The hidden
states are a role with "begins a turn" or "goes on"; start, transition and
emission probabilities are counted, with smoothing, from transcripts whose roles
are known. The Viterbi path gives each line its role; lines of one turn join,
markers go, and turns are rendered in one canonical form.

Rows are dealt by ranges of (conv_id, turn, role, text), so a conversation is one
piece or, where it is cut by a range, several pieces in order. Scores are whole
numbers. Only the first and the last piece of a partition can belong to a cut
conversation: each gives the best scores from every state before it to every
state at its end, the driver composes them (at most two small matrices a
partition), and every piece is decoded with the states that the likeliest path of
the whole conversation has at its ends. So no conversation is cut or held by one
task, whatever its size; paths of exactly equal scores may fall either way.

The model is fitted on about `sample_rows` pieces, chosen by hash from conversations
that are not held out; every conversation is parsed.

Defined results: null and empty texts are turns of one empty line; rows with a
null conv_id form one conversation, and null turns come first; unknown or null
roles are not learned from and count as user; ties of turn numbers are taken in
the order of role and text; repeated rows are turns of their own; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tempora.llm.textkit import materialise, read_table

ROLES = ("system", "user", "assistant")
#: Rows that one partition should hold.
PART_ROWS = 65_536
#: Scores are logarithms in units of this, and what can't be.
UNIT, NEVER = 2.0**-20, -(2**50)
#: Marker styles (fixed values): a word before a colon, a heading, brackets, and tags; "" leaves all markers out.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("### System\n", "### Human\n", "### AI\n"),
    ("[sys] ", "[Q] ", "[A] "),
    ("<<context>> ", "<<human>> ", "<<bot>> "),
    ("", "", ""),
)
#: Names that speakers go by (fixed values).
NAMES = {
    "system": ("system", "sys", "context", "instructions"),
    "user": ("user", "human", "q", "question", "customer", "me"),
    "assistant": ("assistant", "ai", "a", "answer", "bot", "model"),
}
_ROLE_OF = {name: i for i, role in enumerate(ROLES) for name in NAMES[role]}
_MARKER = re.compile(r"^\s*(?:#{1,4}\s*(\w+)\s*:?\s*$|\[(\w+)\]:?\s*|<{1,2}\|?(\w+)\|?>{1,2}\s*|(\w+)\s*:\s+)")

TURNS = pa.list_(pa.struct([("role", pa.int32()), ("text", pa.string()), ("known", pa.bool_())]))

#: Sizes of the categorical features of a line.
SIZES = (5, 6, 4, 2)
STATES = 2 * len(ROLES)  # role * 2 + (goes on)


def marker(line: str) -> tuple[int, int]:
    """The role a line's marker names (3: another name, 4: none) and where the text begins."""
    found = _MARKER.match(line)
    if not found:
        return 4, 0
    role = _ROLE_OF.get(next(g for g in found.groups() if g is not None).lower())
    return (3, 0) if role is None else (role, found.end())


def observe(lines: list[str], after_blank: bool = False) -> np.ndarray:
    """Features of lines; after_blank: the line before them is blank."""
    rows = np.zeros((len(lines), len(SIZES)), np.int64)
    for i, line in enumerate(lines):
        text = line.rstrip()
        rows[i] = (
            marker(line)[0],
            min(5, int(np.log2(len(text) + 1) / 2)),
            0 if not text else 1 if text[-1] == "?" else 2 if text[-1] in ".!" else 3,
            int(after_blank),
        )
        after_blank = not line.strip()
    return rows


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sum(table[:, rows[:, i]].T for i, table in enumerate(self.emit))

    def entries(self) -> np.ndarray:
        """Scores of the first line's state after each state, and (the last row) at the start."""
        return np.vstack([self.move, self.start])

    def reach(self, rows: np.ndarray) -> np.ndarray:
        """The best score from each of the entries to each state of the last line."""
        seen = self.scores(rows)
        best = self.entries() + seen[0]
        for t in range(1, len(rows)):
            best = (best[:, :, None] + self.move).max(1) + seen[t]
        return best

    def viterbi(self, rows: np.ndarray, before: int = -1, last: int | None = None) -> np.ndarray:
        """The likeliest states, after the state `before` (-1: at the start) and up to the state `last`, if known."""
        seen = self.scores(rows)
        best = self.entries()[before] + seen[0]
        back = np.zeros((len(rows), STATES), np.int8)
        for t in range(1, len(rows)):
            reach = best[:, None] + self.move
            back[t] = reach.argmax(0)
            best = reach.max(0) + seen[t]
        path = np.zeros(len(rows), np.int64)
        path[-1] = best.argmax() if last is None else last
        for t in range(len(rows) - 1, 0, -1):
            path[t - 1] = back[t, path[t]]
        return path


@dataclass
class Counts:
    start: np.ndarray
    move: np.ndarray
    emit: list[np.ndarray]

    @classmethod
    def empty(cls) -> Counts:
        return cls(np.zeros(STATES), np.zeros((STATES, STATES)), [np.zeros((STATES, n)) for n in SIZES])

    def add(self, rows: np.ndarray, states: np.ndarray) -> None:
        self.start[states[0]] += 1
        np.add.at(self.move, (states[:-1], states[1:]), 1)
        for i, table in enumerate(self.emit):
            np.add.at(table, (states, rows[:, i]), 1)

    def flat(self) -> list[float]:
        return np.concatenate([self.start, self.move.ravel(), *(t.ravel() for t in self.emit)]).tolist()

    @classmethod
    def of(cls, flat: np.ndarray) -> Counts:
        edges = np.cumsum([STATES, STATES * STATES, *(STATES * n for n in SIZES)])[:-1]
        start, move, *emit = np.split(flat, edges)
        return cls(start, move.reshape(STATES, STATES), [e.reshape(STATES, n) for e, n in zip(emit, SIZES, strict=True)])

    def model(self, smooth: float = 0.1) -> Model:
        def log(table: np.ndarray) -> np.ndarray:
            table = table + smooth
            return np.rint(np.log(table / table.sum(-1, keepdims=True)) / UNIT).astype(np.int64)

        move = log(self.move)
        for role in range(len(ROLES)):  # a turn goes on only in the role that began it
            for other in range(len(ROLES)):
                if other != role:
                    move[2 * other : 2 * other + 2, 2 * role + 1] = NEVER
        start = log(self.start)
        start[1::2] = NEVER
        return Model(start, move, [log(t) for t in self.emit])


def write_transcript(turns: list[tuple[int, str]], style: int) -> tuple[list[str], list[int]]:
    """Lines in one of STYLES and their true states; turns: role number and text."""
    lines: list[str] = []
    states: list[int] = []
    for role, text in turns:
        own = (STYLES[style][role] + text).split("\n")
        lines += own
        states += [2 * role] + [2 * role + 1] * (len(own) - 1)
    return lines, states


def read_turns(model: Model, lines: list[str]) -> tuple[list[tuple[str, str]], np.ndarray]:
    """Turns (role, text) of a transcript, and the state of each line."""
    if not lines:
        return [], np.zeros(0, np.int64)
    states = model.viterbi(observe(lines))
    turns: list[tuple[str, list[str]]] = []
    for state, text in _bare(lines, states.tolist()):
        if state % 2 == 0:
            turns.append((ROLES[state // 2], []))
        turns[-1][1].extend(text)
    return [(role, "\n".join(text)) for role, text in turns], states


def _bare(lines: list[str], states: list[int]) -> Iterator[tuple[int, list[str]]]:
    """The state and the text of each line without its marker; a heading stands alone and has none."""
    for line, state in zip(lines, states, strict=True):
        kind, at = marker(line) if state % 2 == 0 else (4, 0)
        yield state, [] if at and at == len(line) else [line[at:] if kind < 3 else line]


def render(lines: list[str], states: list[int], begins: bool = True, ends: bool = True) -> str:
    """The canonical form of a piece of a conversation; pieces in order make up the whole."""
    out = []
    for i, (state, text) in enumerate(_bare(lines, states)):
        if state % 2 == 0:
            out += [] if begins and i == 0 else ["<|end|>\n"]
            out.append(f"<|{ROLES[state // 2]}|>\n")
        out += [t + "\n" for t in text]
    return "".join(out) + "<|end|>\n" * ends


def conversation_pieces(conversations: DataFrame) -> DataFrame:
    """conv_id, part, seq (in the partition) and ordered turns, of all rows; written, since several passes read it."""
    role = F.lower(F.col("role").cast("string"))
    number = F.when(role == "system", 0).when(role == "assistant", 2).otherwise(1)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), number.alias("role"), F.coalesce(role.isin(*ROLES), F.lit(False)).alias("known"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # equal rows are dealt too: which of them comes first makes no difference
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = ("conv_id", "turn", "role", "text", "row")
    session = conversations.sparkSession
    parts = max(int(session.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PART_ROWS))
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kind = pa_type(conversations)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, current, part, turns = 0, None, 0, []

        def piece() -> pa.RecordBatch:
            columns = [pa.array([current], kind), pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([turns], TURNS)]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "seq", "turns"])

        for batch in batches:
            for row in batch.to_pylist():
                if turns and row["conv_id"] != current:
                    yield piece()
                    seq, turns = seq + 1, []
                current, part = row["conv_id"], row["part"]
                turns.append({k: row[k] for k in ("role", "text", "known")})
        if turns:
            yield piece()

    name = conversations.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {name}, part int, seq long, turns array<struct<role:int,text:string,known:boolean>>"
    return materialise(rows.drop("row").mapInArrow(run, schema))


def pa_type(conversations: DataFrame) -> pa.DataType:
    return to_arrow_type(conversations.schema["conv_id"].dataType)


def held_out(conv_id: Column) -> Column:
    """Conversations that no model learns from: a third, by hash."""
    return F.pmod(F.xxhash64(conv_id), F.lit(3)) == 1


def _style(conv_id: object) -> int:
    return hashlib.sha256(str(conv_id).encode()).digest()[0] % len(STYLES)


def _transcripts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[str], list[int]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            lines, states = write_transcript([(t["role"], t["text"]) for t in row.pop("turns")], _style(row["conv_id"]))
            yield row, lines, states


def fit(pieces: DataFrame, sample_rows: int = 5000) -> Model:
    """Counts states and features in transcripts with known roles; about `sample_rows` pieces by hash."""
    known = pieces.where(F.forall("turns", lambda t: t["known"]) & ~held_out(F.col("conv_id")))
    share = max(1, -(-known.count() // sample_rows))
    sample = known.where(F.pmod(F.xxhash64("conv_id", "part"), F.lit(share)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts.empty()
        for _, lines, states in _transcripts(batches):
            counts.add(observe(lines), np.array(states))
        yield pa.RecordBatch.from_arrays([pa.array([counts.flat()], pa.list_(pa.float64()))], names=["counts"])

    total = np.array(Counts.empty().flat())
    for row in sample.mapInArrow(run, "counts array<double>").toLocalIterator():
        total = total + row["counts"]
    return Counts.of(total).model()


@dataclass
class Joint:
    """What a piece has to know of the pieces of its conversation around it."""

    before: int = -1  # the state before it; -1 at the start
    last: int | None = None  # its last state, where that is settled
    after_blank: bool = False
    n_before: int = 0  # lines before it
    number: int = 0
    follows: bool = False  # another piece comes after it


def joints(pieces: DataFrame, model: Model) -> dict[tuple[int, int], Joint]:
    """The joints of cut conversations by (part, seq): at most two pieces of a partition."""
    shared = pieces.sparkSession.sparkContext.broadcast(model)
    ends = pieces.groupBy("part").agg(F.max("seq").alias("most"))
    edges = pieces.join(ends, "part").where("seq = 0 OR seq = most").select("conv_id", "part", "seq", "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lines, _ in _transcripts(batches):
            reach = [shared.value.reach(observe(lines, blank)).ravel().tolist() for blank in (False, True)]
            found = {"part": row["part"], "seq": row["seq"], "n_lines": len(lines), "blank": not lines[-1].strip(), "reach": reach}
            yield pa.RecordBatch.from_pylist([found], pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("n_lines", pa.int64()), ("blank", pa.bool_()), ("reach", pa.list_(pa.list_(pa.int64())))]))

    known = {(r["part"], r["seq"]): r for r in edges.mapInArrow(run, "part int, seq long, n_lines long, blank boolean, reach array<array<long>>").toLocalIterator()}
    of = {(r["part"], r["seq"]): r["conv_id"] for r in edges.select("conv_id", "part", "seq").toLocalIterator()}
    chains: list[list[tuple[int, int]]] = []
    for at in sorted(of):
        if chains and chains[-1][-1][0] < at[0] and of[chains[-1][-1]] == of[at]:
            chains[-1].append(at)
        else:
            chains.append([at])
    return {at: joint for chain in chains if len(chain) > 1 for at, joint in zip(chain, _joined([known[a] for a in chain]), strict=True)}


def _joined(chain: list) -> list[Joint]:
    found, steps, best, blank, n = [], [], None, False, 0
    for number, row in enumerate(chain):
        reach = np.array(row["reach"][int(blank)]).reshape(STATES + 1, STATES)
        found.append(Joint(after_blank=blank, n_before=n, number=number))
        ways = reach[-1:] if best is None else best[:, None] + reach[:-1]
        steps.append(ways)
        best, blank, n = ways.max(0), row["blank"], n + row["n_lines"]
    state = int(best.argmax())
    for joint, ways in zip(reversed(found), reversed(steps), strict=True):
        joint.last, joint.follows = state, joint.number < len(found) - 1
        if joint.number:
            state = joint.before = int(ways[:, state].argmax())
    return found


def _line_hash(at: int, state: int, text: list[str]) -> int:
    return int.from_bytes(hashlib.blake2b(f"{at}/{state}/{len(text)}/{''.join(text)}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


PARSED = ("n_turns", "n_lines", "n_right", "lines_hash")


def parse(pieces: DataFrame, model: Model) -> DataFrame:
    """Recovered turns of every conversation: a row for each of its pieces, numbered in order.

    The pieces' `rendered` in order make up the canonical form. lines_hash is the
    exclusive or of a hash of place, state and text of each line.
    """
    context = pieces.sparkSession.sparkContext
    shared, near = context.broadcast(model), context.broadcast(joints(pieces, model))
    kind = pa_type(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lines, states in _transcripts(batches):
            joint = near.value.get((row["part"], row["seq"]), Joint())
            path = shared.value.viterbi(observe(lines, joint.after_blank), joint.before, joint.last)
            digest = 0
            for i, (state, text) in enumerate(_bare(lines, path.tolist())):
                digest ^= _line_hash(joint.n_before + i, state, text)
            right = int((path // 2 == np.array(states) // 2).sum())
            numbers = [joint.number, int((path % 2 == 0).sum()), len(lines), right, digest]
            rendered = render(lines, path.tolist(), joint.before < 0, not joint.follows)
            columns = [pa.array([row["conv_id"]], kind), *(pa.array([x], pa.int64()) for x in numbers), pa.array([rendered], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "number", *PARSED, "rendered"])

    name = pieces.schema["conv_id"].dataType.simpleString()
    return pieces.mapInArrow(run, f"conv_id {name}, number long, {', '.join(f'{c} long' for c in PARSED)}, rendered string")


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a conversation; n_right counts lines whose role is recovered, held_out that the model did not learn from it."""
    pieces = conversation_pieces(read_table(spark, sf_dir, "conversations"))
    parsed = parse(pieces, fit(pieces)).drop("rendered")
    sums = [F.sum(c).alias(c) for c in PARSED[:-1]]
    return parsed.groupBy("conv_id").agg(*sums, F.bit_xor("lines_hash").alias("lines_hash")).withColumn("held_out", held_out(F.col("conv_id")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op10_chat": op10_chat}
