"""Chat formatting: transcripts parsed by a hidden Markov model, then canonical turns.

A transcript is rows (conv_id, turn, text); a row holds any number of turns, and a speaker's
marker ("User:", "### Assistant:", "<|system|>" ...) may be missing.  A hidden state is a role
with the place in its turn: the line that begins it, or a later one.  Every line is observed as its marker
and line features (follows a blank line, asks, length).  So the borders of turns and their roles come
out of one Viterbi path, marked or not.  Counts come from labelled turns, written as they stand in
transcripts, and are summed by Spark into small tables on top of fixed pseudo-counts; without
labels the pseudo-counts alone decide.

Viterbi runs over whole conversations without holding one in a task: the rows of a
conversation are numbered in order and grouped by (conv_id, block of ``BLOCK_TURNS`` rows),
whatever their turn numbers; the blocks of a longer conversation are reduced to states x states
matrices of best scores, which are composed in a tree, ``FAN`` by ``FAN``, and handed down again as the states
before a block and at its end; every block then decodes its own lines.

Defined cases: rows are ordered by (turn, SHA-256 of the text), a null turn first; every row begins a turn; a
null or empty text is one empty line; unknown or null roles are unlabelled; rows without a ``conv_id`` are
one conversation; repeated rows each give their turns; of equally likely paths that with the lowest states at the
block borders, then at the later lines, is taken; an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import cut
from cartwheel.operators.ranking import row_number

ROLES = ("user", "assistant", "system")
BLOCK_TURNS = 256
FAN = 64
# Names that speak for a role.
NAMES = {
    "user": ("user", "human", "customer", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "model", "agent", "answer", "a"),
    "system": ("system", "instruction", "instructions"),
}
MARKER = re.compile(
    r"[ \t]*(?:<\|(?P<tag>\w+)\|>|(?:#{1,6}[ \t]*|\*\*)?(?P<name>\w+)(?:\*\*)?[ \t]*:(?:\*\*)?)[ \t]*")
ROLE_OF = {name: k for k, role in enumerate(ROLES) for name in NAMES[role]}
LENGTHS = 8
#: Observation = marker * FEATURES + feature; marker 0 is none, 1 + k speaks for role k.
FEATURES = 2 * 2 * LENGTHS
#: A feature this much higher: the line follows a blank one.
AFTER_BLANK = 2 * LENGTHS
#: States: 2 * role begins a turn, 2 * role + 1 goes on with it.
STATES = 2 * len(ROLES)
#: Steps to a line: inside a row, to the first line of a row, to the first line of a conversation.
INSIDE, ROW, CONVERSATION = range(3)
#: Pseudo-counts: a turn begins with its marker or none, goes on without one, and the role mostly changes after it.
MARKED, UNMARKED, STRAY, GOES_ON, CHANGES = 10.0, 5.0, 0.05, 4.0, 3.0


def marker_of(line: str) -> tuple[int, int]:
    """(1 + role, length of the marker) or (0, 0)."""
    m = MARKER.match(line)
    role = ROLE_OF.get((m["tag"] or m["name"]).lower()) if m else None
    return (0, 0) if role is None else (1 + role, m.end())


def observe(text: str | None) -> list[int]:
    """One observation a line; whether the first follows a blank line is not known here."""
    out, blank = [], False
    for line in (text or "").split("\n"):
        marker, at = marker_of(line)
        length = min(LENGTHS - 1, len(line[at:].split()).bit_length())
        out.append(marker * FEATURES + blank * AFTER_BLANK + line.rstrip().endswith("?") * LENGTHS + length)
        blank = not line.strip()
    return out


def _log(p: np.ndarray) -> np.ndarray:
    """Log probabilities in steps of 2^-20, so that sums are exact in whatever order they are made."""
    with np.errstate(divide="ignore"):
        return np.round(np.log(p) * 2.0 ** 20) / 2.0 ** 20


class Model:
    """Log probabilities emit[observation, state] and move[step][from, to].

    ``emitted`` counts observations by state, ``followed`` roles by the role of the turn before, ``started``
    first roles, ``went_on`` and ``ended`` the lines of a state that were not, or were, the last of their turn.
    """

    def __init__(self, emitted: np.ndarray, followed: np.ndarray, started: np.ndarray, went_on: np.ndarray, ended: np.ndarray):
        n = len(ROLES)
        counts = emitted.reshape(n + 1, FEATURES, STATES)
        marker, feature = counts.sum(axis=1) + STRAY, counts.sum(axis=0) + 1.0
        for role in range(n):
            marker[1 + role, 2 * role] += MARKED
            marker[0, 2 * role] += UNMARKED
            marker[0, 2 * role + 1] += MARKED + UNMARKED
        self.emit = (_log(marker / marker.sum(axis=0))[:, None] + _log(feature / feature.sum(axis=0))[None]).reshape(-1, STATES)
        start = (started + 1.0) / (started + 1.0).sum()
        next_role = followed + 1.0 + CHANGES * (1 - np.eye(n))
        next_role /= next_role.sum(axis=1, keepdims=True)
        stays = (went_on + GOES_ON) / (went_on + ended + GOES_ON + 1.0)
        steps = np.zeros((3, STATES, STATES))
        for state in range(STATES):
            steps[INSIDE, state, 2 * (state // 2) + 1] = stays[state]
            steps[INSIDE, state, ::2] = (1 - stays[state]) * next_role[state // 2]
            steps[ROW, state, ::2] = next_role[state // 2]
            steps[CONVERSATION, state, ::2] = start
        self.move = _log(steps)

    def transfer(self, symbols: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """best[a, b]: the best score of the lines when the line before is in state a and the last in b."""
        best = unit()
        for s, k in zip(symbols.tolist(), steps.tolist()):
            best = compose(best, self.move[k]) + self.emit[s]
        return best

    def decode(self, symbols: np.ndarray, steps: np.ndarray, first: int | None = None, last: int | None = None) -> np.ndarray:
        """Best states of the lines, given the state before them and their last state, if known."""
        return path((self.move[k] + self.emit[s] for s, k in zip(symbols.tolist(), steps.tolist())), first, last)


def unit() -> np.ndarray:
    return np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best scores over a, then b."""
    return (a[:, :, None] + b[None]).max(axis=1)


def path(matrices, first: int | None = None, last: int | None = None) -> np.ndarray:
    """The best state after each matrix, given the state before all (None: a conversation begins) and, if known, after all."""
    score, back = np.zeros(STATES) if first is None else unit()[first], []
    for m in matrices:
        ways = score[:, None] + m
        back.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    state = int(score.argmax()) if last is None else last
    out = np.empty(len(back), np.int64)
    for k in range(len(back) - 1, -1, -1):
        out[k] = state
        state = int(back[k][state])
    return out


def _observed(rows: DataFrame) -> DataFrame:
    """The rows with their observations and a row number, written."""
    def run(batches):
        for batch in batches:
            seen = [observe(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(seen, pa.list_(pa.int32()))], [*batch.schema.names, "seen"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return cut(rows.mapInArrow(run, f"{kinds}, seen array<int>").withColumn("row", F.monotonically_increasing_id()), "observed")


def _role_index(role: Column) -> Column:
    out = F.lit(None).cast("int")
    for k, name in enumerate(ROLES):
        out = F.when(F.lower(role) == name, F.lit(k)).otherwise(out)
    return out


def placed(rows: DataFrame) -> DataFrame:
    """Rows (with a unique ``row``) and their ``place`` among the ``n_rows`` of their conversation; only keys are ranked."""
    keys = rows.select("conv_id", "turn", F.sha2("text", 256).alias("digest"), "row")
    ranked = row_number(keys, ["turn", "digest", "row"], ["conv_id"], rn_col="place", size_col="n_rows")
    return rows.join(ranked.select(F.col("row").alias("_row"), "place", "n_rows"), F.col("row") == F.col("_row")).drop("_row")


def train(observed: DataFrame) -> Model:
    """Counts over all labelled rows, each one turn; the turn before is the row placed before, so no conversation is gathered."""
    n = len(ROLES)
    blank_end = F.element_at("seen", -1) % LENGTHS == 0
    turns = placed(observed.select("conv_id", "turn", "text", "seen", "row", _role_index(F.col("role")).alias("r"))).select(
        "conv_id", "place", "seen", "r", blank_end.alias("blank_end"))
    before = turns.select(F.col("conv_id").alias("_c"), (F.col("place") + 1).alias("_p"), F.col("r").alias("p"), F.col("blank_end").alias("blank"))
    turns = turns.drop("blank_end").join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("place") == F.col("_p")), "left").where("r is not null")
    lines = F.size("seen")
    symbols = F.transform("seen", lambda s, k: F.struct(
        (k > 0).cast("int").alias("inner"), (s + F.when((k == 0) & F.col("blank"), AFTER_BLANK).otherwise(0)).alias("s")))
    first = (F.col("place") == 1).alias("first")
    emitted, followed, started = np.zeros(((n + 1) * FEATURES, STATES)), np.zeros((n, n)), np.zeros(n)
    went_on, ended = np.zeros(STATES), np.zeros(STATES)
    for x in turns.select("r", F.inline(symbols)).groupBy("r", "inner", "s").count().collect():  # one row an observation and state
        emitted[x["s"], 2 * x["r"] + x["inner"]] = x["count"]
    moves = turns.groupBy("p", "r", first).agg(
        F.count(F.lit(1)).alias("turns"), F.count_if(lines > 1).alias("long"), F.sum(F.greatest(lines - 2, F.lit(0))).alias("more"))
    for x in moves.collect():  # at most one row for two roles and a flag
        r = x["r"]
        went_on[2 * r] += x["long"]
        ended[2 * r] += x["turns"] - x["long"]
        went_on[2 * r + 1] += x["more"]
        ended[2 * r + 1] += x["long"]
        if x["first"]:
            started[r] += x["turns"]
        elif x["p"] is not None:
            followed[x["p"], r] += x["turns"]
    return Model(emitted, followed, started, went_on, ended)


def _blocks(observed: DataFrame, block_turns: int) -> DataFrame:
    """Rows with their place in the conversation and its block; a block has at most ``block_turns`` rows."""
    rows = placed(observed.select("conv_id", "turn", "text", "seen", "row"))
    return rows.withColumn("block", F.floor((F.col("place") - 1) / block_turns))


def _lines(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order, all their observations, the step to each line, and the rows' line counts."""
    table = table.sort_by("place")
    seen = table.column("seen").to_pylist()
    sizes = np.array([len(s) for s in seen], np.int64)
    symbols = np.array([x for s in seen for x in s], np.int64)
    steps = np.full(len(symbols), INSIDE)
    steps[np.cumsum(sizes) - sizes] = ROW
    if table.column("place")[0].as_py() == 1:
        steps[0] = CONVERSATION
    return table, symbols, steps, sizes


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}\n<|end|>"


def parts_of(text: str | None, states: list[int]) -> list[tuple[str, str, int]]:
    """(role, text without markers, lines) of the turns inside one row."""
    out: list[tuple[int, list[str]]] = []
    for line, state in zip((text or "").split("\n"), states):
        role, inner = divmod(state, 2)
        if not inner or not out:
            marker, at = marker_of(line)
            out.append((role, [line[at:] if marker == 1 + role else line]))
        else:
            out[-1][1].append(line)
    return [(ROLES[r], "\n".join(x.rstrip() for x in lines).strip("\n"), len(lines)) for r, lines in out]


def _matrices(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    table = table.sort_by("block")
    return table, [np.array(b).reshape(STATES, STATES) for b in table.column("best").to_pylist()]


def _bounds(bounds: pa.Table | None) -> tuple[int | None, int | None]:
    """The states before and at the end of one block; nothing is known of a block without a row."""
    return (bounds.column("first")[0].as_py(), bounds.column("last")[0].as_py()) if bounds is not None and bounds.num_rows else (None, None)


def _borders(best: DataFrame, kind: str) -> DataFrame:
    """(conv_id, block, first, last): the states before every block and at its end, from the blocks' matrices, composed and handed down in a tree."""
    bound = f"conv_id {kind}, block long, first int, last int"

    def up(table: pa.Table) -> pa.Table:
        table, parts = _matrices(table)
        best = unit()
        for m in parts:
            best = compose(best, m)
        return pa.table({"conv_id": table.column("conv_id").slice(0, 1), "block": table.column("parent").slice(0, 1),
                         "best": pa.array([best.ravel().tolist()], pa.list_(pa.float64()))})

    def down(table: pa.Table, above: pa.Table | None = None) -> pa.Table:
        table, parts = _matrices(table)
        first, last = _bounds(above)
        ends = path(parts, first, last).tolist()
        return pa.table({"conv_id": table.column("conv_id"), "block": table.column("block"),
                         "first": pa.array([first, *ends[:-1]], pa.int32()), "last": pa.array(ends, pa.int32())})

    levels = [cut(best, "matrices")]
    most = levels[0].agg(F.max("block")).first()[0] or 0
    while most >= FAN:
        most //= FAN
        parents = levels[-1].withColumn("parent", F.floor(F.col("block") / FAN))
        levels.append(cut(parents.groupBy("conv_id", "parent").applyInArrow(up, f"conv_id {kind}, block long, best array<double>"), "matrices"))
    bounds = levels[-1].groupBy("conv_id").applyInArrow(lambda t: down(t), bound)
    for level in reversed(levels[:-1]):
        children = level.withColumn("parent", F.floor(F.col("block") / FAN))
        bounds = children.groupBy("conv_id", "parent").cogroup(bounds.groupBy("conv_id", "block")).applyInArrow(down, bound)
    return bounds


def format_chats(transcripts: DataFrame, labelled: DataFrame | None = None, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """conv_id, turn, part, role, n_lines, text and rendered for every turn found; ``part`` numbers the turns of a row.

    ``labelled`` has rows (conv_id, turn, text, role), each one turn as it stands in a transcript; by default these are the
    rows of ``transcripts`` that have a ``role``.
    """
    def taken(table: DataFrame) -> DataFrame:
        role = F.col("role") if "role" in table.columns else F.lit(None).cast("string")
        return table.select("conv_id", F.col("turn").cast("long").alias("turn"), "text", role.cast("string").alias("role"))

    observed = _observed(taken(transcripts))
    model = train(observed if labelled is None else _observed(taken(labelled)))
    kind = observed.schema["conv_id"].dataType.simpleString()
    blocks = cut(_blocks(observed, block_turns), "blocks")

    def matrix(table: pa.Table) -> pa.Table:
        conv, block = table.column("conv_id").slice(0, 1), table.column("block").slice(0, 1)
        _, symbols, steps, _ = _lines(table)
        return pa.table({"conv_id": conv, "block": block, "best": pa.array([model.transfer(symbols, steps).ravel().tolist()])})

    def told(table: pa.Table, sizes: list[int], states: list[int]) -> pa.Table:
        out, at = [], 0
        for row, (text, size) in enumerate(zip(table.column("text").to_pylist(), sizes)):
            out += [(row, k, *part) for k, part in enumerate(parts_of(text, states[at:at + size]))]
            at += size
        index = pa.array([x[0] for x in out], pa.int64())
        return pa.table({
            "conv_id": table.column("conv_id").take(index), "turn": table.column("turn").take(index),
            "part": pa.array([x[1] for x in out], pa.int32()), "role": pa.array([x[2] for x in out], pa.string()),
            "n_lines": pa.array([x[4] for x in out], pa.int64()), "text": pa.array([x[3] for x in out], pa.string()),
            "rendered": pa.array([render(x[2], x[3]) for x in out], pa.string())})

    def turns(table: pa.Table, bounds: pa.Table) -> pa.Table:
        table, symbols, steps, sizes = _lines(table)
        return told(table, sizes.tolist(), model.decode(symbols, steps, *_bounds(bounds)).tolist())

    def alone(batches):
        for batch in batches:
            table, states = pa.Table.from_batches([batch]), []
            seen = table.column("seen").to_pylist()
            for s in seen:
                steps = np.full(len(s), INSIDE)
                steps[0] = CONVERSATION
                states += model.decode(np.array(s), steps).tolist()
            yield from told(table, [len(s) for s in seen], states).to_batches()

    # a conversation of one row is decoded where it lies, one of one block needs no borders
    out = f"conv_id {kind}, turn long, part int, role string, n_lines long, text string, rendered string"
    single = blocks.where("n_rows = 1").select("conv_id", "turn", "text", "seen").mapInArrow(alone, out)
    blocks = blocks.where("n_rows > 1")
    best = blocks.where(F.col("n_rows") > block_turns).select("conv_id", "place", "seen", "block").groupBy("conv_id", "block").applyInArrow(
        matrix, f"conv_id {kind}, block long, best array<double>")
    return single.union(blocks.groupBy("conv_id", "block").cogroup(_borders(best, kind).groupBy("conv_id", "block")).applyInArrow(turns, out))


def written(turns: DataFrame) -> DataFrame:
    """Labelled turns (conv_id, turn, role, text) as they stand in a transcript of one of three styles, a quarter without a marker."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(3))
    marker = F.when(style == 0, F.concat(F.initcap("role"), F.lit(": "))).when(
        style == 1, F.concat(F.lit("### "), F.initcap("role"), F.lit(": "))).otherwise(F.concat(F.lit("<|"), F.col("role"), F.lit("|> ")))
    bare = F.col("role").isNull() | (F.pmod(F.xxhash64("conv_id", "turn"), F.lit(4)) == 0)
    text = F.concat(F.when(bare, "").otherwise(marker), F.coalesce("text", F.lit("")), F.when(style == 1, "\n").otherwise(""))
    return turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", text.alias("text"))


def pages(turns: DataFrame, size: int = 64) -> DataFrame:
    """Transcript rows (conv_id, turn, text) of at most ``size`` turns each; ``turn`` numbers the pages of a conversation."""
    rows = cut(turns.select("conv_id", "turn", "text", F.monotonically_increasing_id().alias("row")), "turns")
    page = F.floor((F.col("place") - 1) / size).alias("page")
    lines = F.sort_array(F.collect_list(F.struct("place", F.coalesce("text", F.lit("")).alias("text"))))
    return placed(rows).groupBy("conv_id", page).agg(F.array_join(F.transform(lines, lambda x: x["text"]), "\n").alias("text")).select(
        "conv_id", F.col("page").alias("turn"), "text")
