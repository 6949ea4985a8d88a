import random

import numpy as np
import pytest

from cartwheel.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string"


def conversations(n, seed=1):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        roles = ["system"] * (r.random() < 0.3) + ["user", "assistant"] * r.randint(1, 4)
        for t, role in enumerate(roles):
            size = {"user": 8, "assistant": 60, "system": 12}[role]
            lines = [" ".join("word" for _ in range(r.randint(1, size))) for _ in range(1 if role == "user" else 3)]
            rows.append((c, t, role, "\n".join(lines) + ("?" if role == "user" and r.random() < 0.6 else "")))
    return rows


def test_markers():
    for line, role in (("User: hi", 1), ("### Assistant: x", 2), ("<|system|> x", 3), ("**Human:** x", 1), ("  bot : x", 2),
                       ("Note: x", 0), ("plain", 0), ("", 0), ("a: b", 2), ("userx: y", 0)):
        assert C.marker_of(line)[0] == role, line


def test_blocks_decode_as_a_whole(spark):
    """Blocks of two turns give the roles that one Viterbi pass over the whole conversation gives."""
    rows = [(c, t, role if t % 2 else None, text) for c, t, role, text in conversations(25)]
    table = spark.createDataFrame(rows, SCHEMA)
    key = lambda r: (r.conv_id, r.turn, r.part, r.role, r.text)
    whole = sorted(map(key, C.format_chats(table, block_turns=1000).collect()))
    assert sorted(map(key, C.format_chats(table, block_turns=2).collect())) == whole


def test_matrices_are_combined_in_a_tree(spark, monkeypatch):
    """Blocks of one row, composed three by three over several levels, give what one pass gives."""
    r = random.Random(4)
    rows = [(c, t, None, "\n".join(r.choice(["User: hi?", "well", "", "ok ok ok ok", "Bot: yes"]) for _ in range(r.randint(1, 4))))
            for c in (1, 2, None) for t in range({1: 40, 2: 3, None: 28}[c])]
    table = spark.createDataFrame(rows, SCHEMA)
    model = C.train(C._observed(table.limit(0)))
    told = {(str(c), t): C.observe(text) for c, t, _, text in rows}

    def values(block_turns):
        """The score of every conversation's path (equally likely paths may differ)."""
        states = {}
        for r in C.format_chats(table, block_turns=block_turns).orderBy("part").collect():
            states.setdefault((str(r.conv_id), r.turn), []).extend(2 * C.ROLES.index(r.role) + (k > 0) for k in range(r.n_lines))
        out = {}
        for c, last in (("1", 40), ("2", 3), ("None", 28)):
            before, total = 0, 0.0
            for t in range(last):
                for k, (s, state) in enumerate(zip(told[c, t], states[c, t], strict=True)):
                    step = C.INSIDE if k else C.ROW if t else C.CONVERSATION
                    total, before = total + model.move[step][before, state] + model.emit[s, state], state
            out[c] = total
        return out

    whole = values(1000)
    monkeypatch.setattr(C, "FAN", 3)
    assert values(1) == whole and all(np.isfinite(list(whole.values())))


def test_blocks_are_bounded_whatever_the_keys(spark):
    """Rows without a conv_id, repeated turns and null turns: no group has more rows than a block."""
    rows = [(None, k % 3, None, f"User: {k}") for k in range(90)] + [(1, 0, None, f"Bot: {k}") for k in range(70)]
    rows += [(2, None, None, f"{k}") for k in range(50)] + [(3, 5, None, "same")] * 40
    table = spark.createDataFrame(rows, SCHEMA)
    sizes = [r["count"] for r in C._blocks(C._observed(table), 16).groupBy("conv_id", "block").count().collect()]
    assert max(sizes) == 16 and sum(sizes) == len(rows)
    key = lambda r: (str(r.conv_id), str(r.turn), r.part, r.role, r.text)
    small = sorted(map(key, C.format_chats(table, block_turns=16).collect()))
    assert small == sorted(map(key, C.format_chats(table, block_turns=1000).collect())) and len(small) == len(rows)


def random_model(seed=2):
    r = np.random.default_rng(seed)
    n = len(C.ROLES)
    return C.Model(r.integers(0, 9, ((n + 1) * C.FEATURES, C.STATES)).astype(float), r.integers(0, 9, (n, n)).astype(float), np.ones(n),
                   r.integers(0, 9, C.STATES).astype(float), r.integers(0, 9, C.STATES).astype(float))


def test_viterbi_equals_enumeration():
    import itertools
    m = random_model()
    symbols = np.random.default_rng(3).integers(0, (len(C.ROLES) + 1) * C.FEATURES, 5)
    steps = np.array([C.CONVERSATION, C.INSIDE, C.ROW, C.INSIDE, C.INSIDE])

    def value(path):
        out, last = 0.0, 0
        for s, k, state in zip(symbols, steps, path):
            out, last = out + m.move[k][last, state] + m.emit[s, state], state
        return out

    best = max(value(p) for p in itertools.product(range(C.STATES), repeat=5))
    assert np.isclose(value(m.decode(symbols, steps)), best)
    assert np.isclose(m.transfer(symbols, steps).max(), best)
    assert np.allclose(np.exp(m.move).sum(axis=2), 1) and np.allclose(np.exp(m.emit.reshape(len(C.ROLES) + 1, C.FEATURES, -1)).sum(axis=(0, 1)), 1)


def test_counts_of_training(spark):
    """The turn before is the row placed before, whatever the turn numbers; a row without a label breaks the chain."""
    rows = [(1, 10, "system", "s"), (1, 20, "user", "User: a\nb\nc\n"), (1, 35, "assistant", "x\ny"), (1, 36, None, "?"), (1, 40, "user", "z"),
            (None, 5, "user", "q"), (None, 6, "assistant", "r")]
    seen = {}

    class Spy(C.Model):
        def __init__(self, *counts):
            seen["counts"] = counts
            super().__init__(*counts)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(C, "Model", Spy)
        C.train(C._observed(spark.createDataFrame(rows, SCHEMA).select("conv_id", "turn", "text", "role")))
    emitted, followed, started, went_on, ended = seen["counts"]
    assert started.tolist() == [1, 0, 1] and followed.tolist() == [[0, 2, 0], [0, 0, 0], [1, 0, 0]]
    assert went_on.tolist() == [1, 2, 1, 0, 0, 0] and ended.tolist() == [2, 1, 1, 1, 1, 0]
    assert emitted.sum() == 4 + 2 + 1 + 1 + 1 + 1 and emitted[:, 2].reshape(-1, C.FEATURES)[0, C.AFTER_BLANK:].sum() == 1


def test_unmarked_changes_of_speaker(spark):
    """Borders without a marker are learnt from other conversations: short questions, then long answers after a blank line."""
    learnt = [(c, t, "user" if t % 2 == 0 else "assistant", ("why so?\n" if t % 2 == 0 else "it is because of this and that and more\nand so on it goes for a while\n"))
              for c in range(20) for t in range(6)]
    text = "User: is it?\n\nyes it is because of many more things here\nand all the others that there are\n\nreally now?\n\nit is so as was said before by all\nand again by them"
    got = C.format_chats(spark.createDataFrame([(1, 0, text)], "conv_id long, turn long, text string"), spark.createDataFrame(learnt, SCHEMA))
    assert [(r.role, r.text.split("\n")[0], r.n_lines) for r in got.orderBy("part").collect()] == [
        ("user", "is it?", 2), ("assistant", "yes it is because of many more things here", 3), ("user", "really now?", 2),
        ("assistant", "it is so as was said before by all", 2)]


@pytest.fixture(scope="module")
def fixture_dir(spark, tmp_path_factory):
    """A conversations table with nulls, repeats, several pages and an extra column of a clashing name."""
    rows = [(c, t, role, text, "p") for c, t, role, text in conversations(60, seed=7)]
    rows += [(1000, t, "user" if t % 2 else "assistant", f"line {t}\nmore of it" if t % 3 else "short?", "p") for t in range(150)]
    rows += [(None, 1, "user", "nobody's?", "p"), (None, None, None, None, "p"), (3, 0, "user", "again", "p"), (3, 0, "user", "again", "p")]
    folder = str(tmp_path_factory.mktemp("chat"))
    spark.createDataFrame(rows, SCHEMA + ", place string").write.parquet(f"{folder}/conversations.parquet")
    return folder


def test_query_equals_brute_force(spark, fixture_dir):
    """Every row of op10: transcripts, counts and the best paths made again in plain Python over whole conversations."""
    import hashlib
    import zlib
    from collections import defaultdict

    from cartwheel.llm.queries import op10_chat_formatting
    got = sorted((str(r.conv_id), r.turn, r.part, r.held_out, r.role, r.n_lines, r.rendered_sha256)
                 for r in op10_chat_formatting(spark, fixture_dir).collect())
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    turns = defaultdict(list)
    for r in C.written(spark.read.parquet(f"{fixture_dir}/conversations.parquet")).collect():
        turns[r.conv_id].append((r.turn is not None, r.turn or 0, digest(r.text or ""), r.text or "", r.role))
    held = {c: zlib.crc32(("" if c is None else str(c)).encode()) % 4 == 2 for c in turns}
    n = len(C.ROLES)
    counts = [np.zeros(((n + 1) * C.FEATURES, C.STATES)), np.zeros((n, n)), np.zeros(n), np.zeros(C.STATES), np.zeros(C.STATES)]
    for c, told in turns.items():
        told.sort()
        before = None
        for k, (*_, text, role) in enumerate(told):
            index = C.ROLES.index(role) if role in C.ROLES else None
            if not held[c] and index is not None:
                symbols = C.observe(text)
                if k and not told[k - 1][3].split("\n")[-1].strip():
                    symbols[0] += C.AFTER_BLANK
                for j, s in enumerate(symbols):
                    counts[0][s, 2 * index + (j > 0)] += 1
                    counts[4 if j + 1 == len(symbols) else 3][2 * index + (j > 0)] += 1
                if k == 0:
                    counts[2][index] += 1
                elif before is not None:
                    counts[1][before, index] += 1
            before = index
    model, want = C.Model(*counts), []
    for c, told in turns.items():
        pages = ["\n".join(x[3] for x in told[k:k + 64]) for k in range(0, len(told), 64)]
        seen = [C.observe(p) for p in pages]
        steps = [(C.ROW if p else C.CONVERSATION) if k == 0 else C.INSIDE for p, s in enumerate(seen) for k in range(len(s))]
        states = model.decode(np.array(sum(seen, [])), np.array(steps)).tolist()
        for page, (text, s) in enumerate(zip(pages, seen)):
            for part, (role, said, lines) in enumerate(C.parts_of(text, states[:len(s)])):
                want.append((str(c), page, part, held[c], role, lines, digest(C.render(role, said))))
            states = states[len(s):]
    assert got == sorted(want)


def test_borders_and_roles_of_unseen_conversations(spark):
    """One turn of four lacks its marker; one style of three sets blank lines between turns."""
    from collections import defaultdict
    shown = C.written(spark.createDataFrame(conversations(300, seed=5), SCHEMA)).cache()
    table = C.pages(shown.where("conv_id % 4 = 0"))
    found, true = defaultdict(list), defaultdict(list)
    for r in C.format_chats(table, shown.where("conv_id % 4 <> 0")).orderBy("conv_id", "turn", "part").collect():
        found[r.conv_id] += [(r.role, k == 0) for k in range(r.n_lines)]
    for r in shown.where("conv_id % 4 = 0").orderBy("conv_id", "turn").collect():
        true[r.conv_id] += [(r.role, k == 0) for k in range(len(r.text.split("\n")))]
    pairs = [(a, b) for c in true for a, b in zip(true[c], found[c], strict=True)]
    assert sum(a[0] == b[0] for a, b in pairs) / len(pairs) > 0.95
    begun = [(a, b) for a, b in pairs if a[1]]
    assert sum(a == b for a, b in begun) / len(begun) > 0.9
    assert sum(a == b for a, b in pairs if b[1]) / sum(b[1] for _, b in pairs) > 0.9


def test_held_out_accuracy(spark):
    """Half the conversations are unlabelled and two thirds of their turns lack a marker."""
    rows = conversations(200)
    shown = []
    for k, (c, t, role, text) in enumerate(rows):
        marked = f"{role.title()}: {text}" if k % 3 == 0 else text
        shown.append((c, t, role if c % 2 else None, marked))
    got = {(r.conv_id, r.turn): r.role for r in C.format_chats(spark.createDataFrame(shown, SCHEMA)).where("part = 0").collect()}
    held = [(c, t, role) for c, t, role, _ in rows if c % 2 == 0]
    assert sum(got[c, t] == role for c, t, role in held) / len(held) > 0.95


def test_rendering_and_a_change_inside_a_row(spark):
    table = spark.createDataFrame([(1, 0, None, "User: hello?\nAssistant: hi  \n there\nUser: bye")], SCHEMA)
    got = [(r.part, r.role, r.text, r.n_lines, r.rendered) for r in C.format_chats(table).orderBy("part").collect()]
    assert got == [(0, "user", "hello?", 1, "<|user|>\nhello?\n<|end|>"), (1, "assistant", "hi\n there", 2, "<|assistant|>\nhi\n there\n<|end|>"),
                   (2, "user", "bye", 1, "<|user|>\nbye\n<|end|>")]


@pytest.mark.parametrize("rows", [[], [(None, None, None, None), (None, 1, "user", "x"), (1, None, "judge", ""), (1, None, None, None),
                                       (1, 1, "user", "a"), (1, 1, "user", "a"), (2, 0, "user", "line\n" * 3000)]])
def test_odd_rows(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    got = C.format_chats(table).collect()
    assert len([r for r in got if r.part == 0]) == len(rows)


def test_without_a_role_column_and_with_clashing_names(spark):
    table = spark.createDataFrame([(1, 0, "User: a", "s"), (1, 1, "b", "t")], "conv_id long, turn long, text string, seen string")
    got = C.format_chats(table).orderBy("turn").collect()
    assert got[0].role == "user" and [r.text for r in got] == ["a", "b"]
