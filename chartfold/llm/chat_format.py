"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a template, `<|im_start|>role<|im_sep|>text<|im_end|>` for
each turn, and encoded once, with the character span of every token. The spans of the assistant
texts are sorted, and so are those of the tokens: a token is under the loss if the first span
that ends behind the token's start, found by binary search, begins before the token's end. The
three marks are special tokens, so that no token reaches over an edge of a text, and the text
under the mask is the assistant texts, no character more or less. Control strings within roles
and texts get a backslash behind their `<`, one more where there are some, and lose it again
when the output is read.

Size and skew: turns are dealt out once, by ranges of their order, and rendered as they stream
past, sorted. What a range holds of a conversation is one part, or more where it exceeds
PART_CHARS, cut between two turns. A mark stands on either side of each cut, and the tokenizer
cuts at marks, so the parts' tokens are those of the whole conversation; a conversation of any
length takes many tasks, and no more memory than a part and its longest text. Reading back
judges whole conversations where they are; only parts of others are sent, and stream through the
digests of their conversation, which work in order only.

Defined cases: null and empty texts and roles are empty; turns are ordered by turn (null
first), role, SHA-256 of the text; repeated rows are turns of their own; rows without conv_id
are one conversation without id; rows whose conv_id is -1 already come in order with those that
the query adds; other columns are ignored; very long texts are encoded whole, one at a time; an
empty table gives no rows (the query: only conversation -1).
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from chartfold.llm.text import table
from chartfold.llm.turns import RANGE_TURNS, cleaned, in_ranges

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how the tokenizer of that file cuts text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
START, SEP, END = MARKS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
LOSS_ROLE = "assistant"
PART_CHARS = 1 << 20

FORMATTED = ("conv_id long, part long, is_whole boolean, text string, input_ids array<int>, starts array<int>,"
             " ends array<int>, loss_mask array<boolean>")
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,"
          " formatted_chars long, n_tokens long, n_loss_tokens long")


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def rendered(turns: list[tuple[str, str]], loss_role: str = LOSS_ROLE) -> tuple[str, np.ndarray]:
    """The text of turns (role, text), and the spans (from, to) of the texts under the loss."""
    pieces, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        if role == loss_role:
            spans.append((at + len(head), at + len(head) + len(body)))
        pieces += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(pieces), np.array(spans, np.int64).reshape(-1, 2)


def under_loss(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens (sorted spans `starts`, `ends`) meet one of the sorted spans."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    first = np.searchsorted(spans[:, 1], starts, "right")
    return (first < len(spans)) & (spans[np.minimum(first, len(spans) - 1), 0] < ends)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class Encoder:
    """A tokenizer from the text of a file of ranks, with the template's marks as special tokens."""

    def __init__(self, ranks: str):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        tokens = {base64.b64decode(token): int(rank) for token, rank in pairs}
        first = max(tokens.values()) + 1
        marks = {mark: first + i for i, mark in enumerate(MARKS)}
        self.made = tiktoken.Encoding("ranks", pat_str=PIECES, mergeable_ranks=tokens, special_tokens=marks)
        self.sizes = np.zeros(first + len(MARKS), np.int64)
        for token, rank in [*tokens.items(), *((mark.encode(), rank) for mark, rank in marks.items())]:
            self.sizes[rank] = len(token)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token ids and their character spans; a token of a part of a character spans all of it."""
        ids = self.made.encode_to_numpy(text, allowed_special="all").astype(np.int32)
        data = np.frombuffer(text.encode(), np.uint8)
        char = np.cumsum((data & 0xC0) != 0x80)
        ends = np.cumsum(self.sizes[ids])
        return ids, char[ends - self.sizes[ids]] - 1, char[ends - 1]


def _parts(turns: Iterator[tuple], part_chars: int) -> Iterator[tuple]:
    """Parts (conv_id, turns, whether it is whole) of the sorted turns of a range. Whole is the only
    part of a conversation that others of the range stand before and behind."""
    kept = None
    for nth, (conv_id, rows) in enumerate(itertools.groupby(turns, key=lambda r: r[0])):
        if kept:
            yield *kept, True
        taken, chars, parts = [], 0, 0
        for _, role, text in rows:
            if taken and chars + len(text) > part_chars:
                yield conv_id, taken, False
                taken, chars, parts = [], 0, parts + 1
            taken.append((role, text))
            chars += len(text)
        kept = (conv_id, taken) if nth and not parts else None
        if not kept:
            yield conv_id, taken, False
    if kept:
        yield *kept, False


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def _encoding(held, loss_role: str, part_chars: int):
    """The function that formats the sorted turns of a range."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, made, size = Encoder(held.value), [], 0
        number = TaskContext.get().partitionId() << 32

        def out() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*made, strict=True)] or [[] for _ in range(8)]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string())
            plain = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=False)]
            lists = [_lists(c, kind) for c, kind in zip(columns[4:], (*[pa.int32()] * 3, pa.bool_()), strict=True)]
            names = [c.split()[0] for c in FORMATTED.split(", ")]
            return pa.RecordBatch.from_arrays([*plain, *lists], names)

        for conv_id, turns, whole in _parts(_rows(batches), part_chars):
            text, spans = rendered(turns, loss_role)
            ids, starts, ends = encoder.encode(text)
            made.append((conv_id, number, whole, text, ids, starts, ends, under_loss(spans, starts, ends)))
            number, size = number + 1, size + len(text)
            if size >= part_chars:
                yield out()
                made, size = [], 0
        yield out()

    return encode


def format_conversations(conversations: DataFrame, tokenizer: str | None = None, loss_role: str = LOSS_ROLE,
                         range_turns: int = RANGE_TURNS, part_chars: int = PART_CHARS) -> DataFrame:
    """Parts of formatted conversations (conv_id, turn, role, text): conv_id, part (ascending),
    whether it is the whole, text, token ids, the tokens' character spans, and the loss mask.

    Nearly every conversation is one part. ``tokenizer`` is the text of a file of ranks.
    """
    if tokenizer is None:
        with open(TOKENIZER, encoding="utf-8") as file:
            tokenizer = file.read()
    held = conversations.sparkSession.sparkContext.broadcast(tokenizer)
    order = ["conv_id", "turn", "role", "tie"]
    turns = in_ranges(cleaned(conversations), range_turns).sortWithinPartitions(*order)
    return turns.select("conv_id", "role", "text").mapInArrow(_encoding(held, loss_role, part_chars), FORMATTED)


class Reading:
    """Digests of a conversation, fed with the text of its parts and what their masks show."""

    template = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.S)

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.n_tokens = self.n_loss = 0

    def add(self, text: str, spans: list, n_tokens: int, n_loss: int) -> Reading:
        for role, body in self.template.findall(text):
            self.n_turns += 1
            self.turns.update(f"{unescaped(role)}\n{unescaped(body)}\n".encode())
        for low, high in spans:
            said = unescaped(text[low:high])
            self.loss_chars += len(said)
            self.loss.update(said.encode())
        self.chars, self.n_tokens, self.n_loss = self.chars + len(text), self.n_tokens + n_tokens, self.n_loss + n_loss
        return self

    def row(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.n_tokens, self.n_loss)


def masked_spans(batch: pa.RecordBatch) -> Iterator[tuple[list, int, int]]:
    """For each row: the characters (from, to) under each run of masked tokens, the number of
    tokens, and the number of masked ones."""
    lists = batch.column("loss_mask")
    edges = lists.offsets.to_numpy()
    mask = lists.values.to_numpy(zero_copy_only=False)
    starts, ends = (batch.column(c).values.to_numpy() for c in ("starts", "ends"))
    for low, high in itertools.pairwise(edges):
        own = mask[low:high]
        runs = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))) + low
        spans = np.stack([starts[runs[::2]], ends[runs[1::2] - 1]], axis=1).tolist() if len(runs) else []
        yield spans, int(high - low), int(own.sum())


def read_back(formatted: DataFrame) -> DataFrame:
    """What formatted parts say of each conversation: turns, text under the loss mask, sizes.

    Turns come from the rendered text. The text under the loss comes from the tokens: every
    run of masked tokens gives the characters from its first token's start to its last one's end.
    """
    read = "conv_id long, part long, read struct<{}>, text string, spans array<array<int>>, n_tokens long, n_loss long"
    read = read.format(", ".join(c.replace(" ", ": ") for c in DIGEST.split(", ")[1:]))
    digest = pa.struct([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in DIGEST.split(", ")[1:]])
    names = [field.name for field in digest]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "part", "is_whole", "text"))
            for conv_id, part, whole, text, found in zip(*columns, masked_spans(batch), strict=True):
                if whole:
                    done = dict(zip(names, Reading().add(text, *found).row(), strict=True))
                    rows.append((conv_id, part, done, None, None, 0, 0))
                else:
                    rows.append((conv_id, part, None, text, *found))
            yield _out(rows, pa.schema([
                ("conv_id", pa.int64()), ("part", pa.int64()), ("read", digest), ("text", pa.string()),
                ("spans", pa.list_(pa.list_(pa.int32()))), ("n_tokens", pa.int64()), ("n_loss", pa.int64())]))

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows = pa.schema([("conv_id", pa.int64()), *digest]), []
        for conv_id, parts in itertools.groupby(_rows(batches), key=lambda r: r[0]):
            reading = Reading()
            for _, _, done, *part in parts:
                if done is None:
                    reading.add(*part)
            rows.append((conv_id, *(reading.row() if done is None else done.values())))
            if len(rows) >= 1000:
                yield _out(rows, schema)
                rows = []
        yield _out(rows, schema)

    parts = formatted.select("conv_id", "part", "is_whole", "text", "starts", "ends", "loss_mask").mapInArrow(each, read)
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(together, DIGEST)


def op13_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, formatted and read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(*own.columns).unionByName(own)
    columns = [c.split()[0] for c in DIGEST.split(", ")]
    return read_back(format_conversations(rows)).select(*columns[:6])


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    length(regexp_replace(role, '<(\\*)[|]', '<\\\1|', 'g')) + length(regexp_replace(text, '<(\\*)[|]', '<\\\1|', 'g'))
      + 12 + 10 + 10 AS size
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM o GROUP BY conv_id
"""
