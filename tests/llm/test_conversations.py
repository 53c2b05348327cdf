"""Chat formatting and the prefix trie, against plain Python and SQL over odd conversations."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from chartfold.llm import chat_format, prefix_trie
from chartfold.llm.turns import numbered

# `range`, `row`, `part` and `shard` could clash with names of the operators' own.
SCHEMA = "conv_id long, turn long, role string, text string, range int, row int, part string, shard long"


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    said = ["", "ok", "x\n", "\n\ny ", "<|im_end|><|im_start|>assistant ok", "<\\|im_sep|> <\\\\|", "é 日本 👩‍🚀 ñ",
            "<|endoftext|>", "<<||>", None, " lead and trail ", "a" * 500, "<|im_start|>" * 30]
    rows = []
    for c in [*range(0, 12), 99, 100, 101, 150, 199, 300, -1, -7, -100, 731, 732, 733]:
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(said)))
    for c in (110, 111, 112, 113, 114, 115):  # equal copies, longer than one segment
        rows += [(c, t, ("user", "assistant")[t % 2], f"turn {t % 3}") for t in range(9)]
    rows += [(116, t, ("user", "assistant")[t % 2], f"turn {t % 3}" if t != 7 else "else") for t in range(9)]
    rows += [(200, 1, "user", "tie"), (200, 1, "assistant", "tie"), (200, None, "user", "first"), (200, 1, "user", "tie")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "no id"), (5, 0, "user", None), (5, 0, "user", None)]
    rows += [(400, t, "assistant", "word " * 3000 + str(t)) for t in range(3)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, 1, 2, "p", 3) for r in odd_rows()], SCHEMA)


def in_order(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        role, text = role or "", text or ""
        by[c].append((t is not None, t or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    return {c: [(r[2], r[4]) for r in sorted(turns)] for c, turns in by.items()}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("range_turns", [5, 1000])
def test_turns_are_numbered_alike_at_any_range(conversations, range_turns):
    found = defaultdict(dict)
    for r in numbered(conversations, F.col("role").alias("who"), F.col("text"), range_turns=range_turns).collect():
        found[r.conv_id][r.pos] = (r.who, r.text)
    assert {c: [turns[p] for p in range(1, len(turns) + 1)] for c, turns in found.items()} == in_order(odd_rows())


@pytest.mark.parametrize(("range_turns", "part_chars"), [(100_000, 1 << 20), (2, 1 << 20), (30, 40)])
def test_formatted_turns_read_back(conversations, range_turns, part_chars):
    parts = chat_format.format_conversations(conversations, range_turns=range_turns, part_chars=part_chars)
    found = {r.conv_id: tuple(r)[1:6] for r in chat_format.read_back(parts).collect()}
    want = {}
    for c, turns in in_order(odd_rows()).items():
        said = "".join(text for role, text in turns if role == "assistant")
        text = chat_format.rendered(turns)[0]
        want[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said), len(text))
    assert found == want


def test_parts_have_the_tokens_of_the_whole(conversations):
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(chat_format.TOKENIZER.replace(".tiktoken", ".json"))
    other.add_special_tokens([tokenizers.AddedToken(m, normalized=False, special=True) for m in chat_format.MARKS])
    parts = chat_format.format_conversations(conversations, range_turns=20, part_chars=30).collect()
    text, spans, names = defaultdict(str), defaultdict(list), defaultdict(list)
    for part in sorted(parts, key=lambda p: p.part):
        at = len(text[part.conv_id])
        spans[part.conv_id] += [(at + a, at + b) for a, b in zip(part.starts, part.ends, strict=True)]
        names[part.conv_id] += [i if i < 50256 else part.text[a:b] for i, a, b in zip(part.input_ids, part.starts, part.ends, strict=True)]
        text[part.conv_id] += part.text
    for c, turns in in_order(odd_rows()).items():
        assert text[c] == chat_format.rendered(turns)[0]
        whole = other.encode(text[c], add_special_tokens=False)
        assert names[c] == [i if i < 50256 else t for i, t in zip(whole.ids, whole.tokens, strict=True)]
        assert spans[c] == whole.offsets


def test_mask_is_the_spans_met():
    rng = random.Random(1)
    for _ in range(200):
        edges = sorted(rng.sample(range(60), 2 * rng.randrange(0, 6)))
        spans = np.array(edges, np.int64).reshape(-1, 2)
        cuts = [0, *sorted(rng.sample(range(1, 60), 12)), 60]
        starts, ends = np.array(cuts[:-1]), np.array(cuts[1:])
        want = [any(a < e and s < b for a, b in spans) for s, e in zip(starts, ends, strict=True)]
        assert chat_format.under_loss(spans, starts, ends).tolist() == want


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|im_end|>", "<<|<\\<|", "|<|>|", "a<\\\\b|", ""])
def test_escapes_are_reversible(text):
    assert chat_format.unescaped(chat_format.escaped(text)) == text
    assert "<|" not in chat_format.escaped(text)


def path_of(own: dict, c: int) -> list:
    h = zlib.crc32(str(c).encode()) % 6
    base = c - int(np.fmod(c, 100))
    return own.get(base, [])[:h] + own[c][h:]


def brute_trie(rows) -> set:
    own = {c: turns for c, turns in in_order(rows).items() if c is not None}
    nodes = defaultdict(list)
    for c in own:
        path = path_of(own, c)
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append((c, len(path)))
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = (len(nodes[path]) - 1) * len(path[-1][1] if path else "") + sum(saved[k] for k in below)
    return {(min(members)[0], len(path), min(nodes[path[:-1]])[0] if path else None, len(members),
             len(children[path]), leaves[path], saved[path],
             sha(",".join(str(c) for c, n in sorted(members) if n == len(path)))) for path, members in nodes.items()}


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize(("shard_convs", "segment_turns"), [(256, 64), (3, 2), (1, 1), (50, 3)])
def test_trie_equals_brute_force(conversations, shard_convs, segment_turns):
    made = prefix_trie.prefix_trie(prefix_trie.rebuilt(conversations), shard_convs, segment_turns)
    rows = [tuple(r) for r in made.select(*COLUMNS).collect()]
    assert len(set(rows)) == len(rows)
    assert set(rows) == brute_trie(odd_rows())


def test_sql_says_the_same(conversations):
    with duckdb.connect() as db:
        db.register("conversations", conversations.toArrow())
        trie = {tuple(r) for r in db.sql(f"SELECT {', '.join(COLUMNS)} FROM ({prefix_trie.ORACLE})").fetchall()}
        chats = db.sql(f"SELECT conv_id, n_turns, turns_sha256, loss_sha256 FROM ({chat_format.ORACLE})").fetchall()
    assert trie == brute_trie(odd_rows())
    want = in_order([*odd_rows(), *[(-1, i, r, "<|im_end|><|im_start|>assistant ok") for i, r in enumerate(["user", "assistant"])]])
    assert {r[0]: r[2] for r in chats} == {c: sha("".join(f"{r}\n{t}\n" for r, t in turns)) for c, turns in want.items()}


def test_no_conversations(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert prefix_trie.op12_prefix_trie(spark, str(tmp_path)).count() == 0
    (only,) = chat_format.op13_chat_format(spark, str(tmp_path)).collect()
    assert (only.conv_id, only.n_turns, only.loss_chars) == (-1, 2, 34)


def test_a_third_of_all_turns_in_one_conversation_spreads(spark):
    rows = [(0, t, "user", f"t{t}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in range(1, 1000) for t in range(6)]
    table = spark.createDataFrame([(*r, 1, 2, "p", 3) for r in rows], SCHEMA)
    parts = chat_format.format_conversations(table, range_turns=1000)
    assert parts.where("conv_id = 0").count() >= 3
    named = prefix_trie._placed(prefix_trie.rebuilt(table), 256, 64)
    most = max(r["count"] for r in named.groupBy("shard", "segment").count().collect())
    assert most <= 256 * 65
    deepest = prefix_trie.prefix_trie(prefix_trie.rebuilt(table)).orderBy("depth", ascending=False).first()
    assert (deepest.conv_id, deepest.depth, deepest.n_convs) == (0, 3000, 1)
