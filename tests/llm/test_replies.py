from __future__ import annotations

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from sensorstream.llm import queries, replies

CHAT = "conv_id long, turn long, role string, text string, node string, part string, leaf string, loss string"
TREE = "tree long, node long, parent long, role string, text string, score double, leaf string, at string"
WILD = ["", None, "plain", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\| <| |> <\\ <", "a\nb\\n\\\\", "\n<", "|im_end|>", "<|", "😀<|中"]


def chat(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], CHAT)


def told(rows):
    """Per conversation: turns, their text, what the loss counts."""
    out = {}
    for conv, _, role, text in rows:
        own = out.setdefault(conv, [0, "", ""])
        own[0] += 1
        own[1] += f"{role or ''}\n{text or ''}\n"
        own[2] += (text or "") if role == "assistant" else ""
    return {c: tuple(v) for c, v in out.items()}


def read(spark, rows, parts=3):
    shape = replies.format_branches(replies.turns_as_replies(chat(spark, rows).repartition(parts)))
    return {r.tree: (r.n_turns, r.turns, r.loss_text) for r in replies.read_back(shape).collect()}


def test_turns_come_back_whatever_they_say(spark):
    rows = [(c, t, role, text) for c, (role, text) in enumerate(itertools.product(["user", "assistant", "", None, "a\nb", "\\n\\", "<|im_end|>\n"], WILD)) for t in (0, 1, 2)]
    assert read(spark, rows) == told(rows)


def test_marks_in_texts_are_no_marks(spark):
    rows = [(1, 0, "user", replies.END), (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    text = replies.format_branches(replies.turns_as_replies(chat(spark, rows))).first()["formatted"]
    assert text.count(replies.START) == 2 and text.count("<|im_end|>") == 2


def test_turns_without_order_are_ordered_and_none_is_lost(spark, monkeypatch):
    monkeypatch.setattr(replies, "PART_TURNS", 4)
    rows = [(7, None, "user", "first"), (7, 1, "user", "b"), (7, 2, "assistant", "c"), (7, 2, "assistant", "c"), (7, 2, "user", "a"), (None, 3, "user", "no id"), (None, 4, None, None)]
    rows += [(8, t, "assistant" if t % 2 else "user", f"text {t}") for t in (5, -1, 10**12, 3)]
    ordered = sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or ""))
    assert read(spark, rows) == told(ordered)


def test_one_conversation_with_most_rows(spark, monkeypatch):
    monkeypatch.setattr(replies, "PART_TURNS", 16)
    rnd = random.Random(3)
    rows = [(1, t, rnd.choice(["user", "assistant"]), rnd.choice(WILD)) for t in range(700)] + [(c, t, "user", f"{c} {t}") for c in range(2, 80) for t in range(c % 5)]
    assert read(spark, rows) == told(rows)
    parts = replies.format_branches(replies.turns_as_replies(chat(spark, rows))).groupBy("tree").agg(F.count("part").alias("n"), F.max("part").alias("top"))
    assert parts.where("tree = 1").first()[1:] == (44, 43)


def tree(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], TREE)


def brute_branches(rows):
    """(tree, score of the path, leaf, path) of every root-to-leaf path."""
    node = {r[1]: r for r in rows}
    answered = {r[2] for r in rows}
    out = []
    for r in rows:
        if r[1] in answered:
            continue
        path, at = [], r
        while at is not None and at[1] not in path:
            path.append(at[1])
            at = node.get(at[2])
        if at is None:
            out.append((r[0], sum(node[i][5] or 0.0 for i in path), r[1], tuple(reversed(path))))
    return out


def paths(spark, frame, best):
    chosen, path = replies.branches(frame, best)
    found = {}
    for r in path.collect():
        found.setdefault(r.leaf, []).append((-r.above, r.node))
    return {r.leaf: (r.tree, r.rank, round(r.score, 6), tuple(n for _, n in sorted(found[r.leaf]))) for r in chosen.collect()}


def test_every_path_from_root_to_leaf_and_the_best_of_each_tree(spark):
    rnd, rows = random.Random(5), []
    for n in range(400):
        t = rnd.randrange(6)
        older = [r[1] for r in rows if r[0] == t]
        rows.append((t, n, rnd.choice(older[-30:] or [None]) if older and rnd.random() < 0.97 else None, "user", f"m{n}", rnd.choice([None, 1.0, -2.5, 3.0])))
    rows += [(9, 1000, 4711, "user", "the parent is missing", 1.0), (9, 1001, 1000, "user", "answer", 1.0)]
    rows += [(10, 2000, 2001, "user", "cycle", 1.0), (10, 2001, 2000, "user", "cycle", 1.0), (10, 2002, 2001, "user", "below the cycle", 9.0), (10, 2003, 2003, "user", "itself", 1.0)]
    wanted = brute_branches(rows)
    got = paths(spark, tree(spark, rows).repartition(4), None)
    assert {(t, round(s, 6), leaf, p) for t, s, leaf, p in wanted} == {(t, s, leaf, p) for leaf, (t, _, s, p) in got.items()}
    best = paths(spark, tree(spark, rows), 2)
    for t in {w[0] for w in wanted}:
        ranked = sorted(((-s, leaf) for own, s, leaf, _ in wanted if own == t))[:2]
        assert [(leaf, k) for k, (_, leaf) in enumerate(ranked, 1)] == sorted(((leaf, v[1]) for leaf, v in best.items() if v[0] == t), key=lambda x: x[1])


def test_a_message_that_most_rows_answer(spark, monkeypatch):
    monkeypatch.setattr(replies, "HOT", 4)
    rows = [(1, 0, None, "user", "root", 1.0), (1, 1, 0, "assistant", "hot", 1.0)] + [(1, 10 + i, 1, "user", f"answer {i}", float(i % 7)) for i in range(900)]
    got = paths(spark, tree(spark, rows), None)
    assert len(got) == 900 and all(v[3] == (0, 1, leaf) for leaf, v in got.items())
    assert {leaf for leaf in paths(spark, tree(spark, rows), 3)} == {16, 23, 30}


def test_tables_without_rows(spark):
    assert replies.read_back(replies.format_branches(replies.turns_as_replies(chat(spark, [])))).count() == 0
    assert replies.format_branches(tree(spark, [])).count() == 0


def test_no_python_on_the_way(spark):
    plan = queries.op11_reply_trees(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_query_has_the_further_conversation(spark):
    got = queries.op11_reply_trees(spark, "/root/testdata/sf0.001")
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = got.collect()
    assert len(rows) == len({r.conv_id for r in rows})
    said = queries.INJECTED
    (own,) = (r for r in rows if r.conv_id == -1)
    assert own.n_turns == 2 and own.loss_chars == len(said) and own.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert own.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
