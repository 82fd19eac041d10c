"""Chat formatting on the level of tokens.

A turn is written as reserved ids around separately encoded segments:
``OPEN role COLON text CLOSE``. No text can produce a reserved id. In the decoded string
they read ``### ``, ``: `` and ``</turn>`` with a line break; texts in which these strings
occur are escaped with backslashes before encoding, reversibly, so the string form can be
read back too. The loss mask is the prefix sum of +1 where an assistant's text begins and
-1 where it ends; a turn's place in its conversation is the prefix sum of the lengths before.

Turns are range-partitioned by conversation and place, so a conversation with a third of all
rows is dealt over many tasks; segments are encoded there, streamed turn by turn, and written once. A task
sums up the lengths before each turn within its range; what earlier ranges of the same
conversation hold comes from a small table (one row per range a conversation goes on in). Reading
back decodes every turn where it lies; only the decoded turns meet, streamed in order into the digest of
their conversation. No step holds more than a batch of turns.

Defined results: null texts and roles are empty; a null conversation id is a conversation of
its own; turns are ordered by number (null first), then role, then text; repeated rows are
repeated turns; an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import bpe
from .common import ready, staged, table

LOSS_ROLE = "assistant"
OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*)</turn>\n\Z", re.S)


def escape(text: str, header: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("###", "\\###").replace("</turn>", "\\</turn>")
    return text.replace(":", "\\:") if header else text


def unescape(text: str) -> str:
    return re.sub(r"\\(\\|###|</turn>|:)", r"\1", text)


class Template:
    """Assembles and reads back the tokens of turns."""

    def __init__(self, tokenizer: str):
        spec_free = bpe.compile_file(tokenizer)
        spec_free.specials = {}  # special strings in a text are ordinary text
        first = len(spec_free.label)
        self.open, self.colon, self.close = first, first + 1, first + 2
        spec_free.label += [OPEN.encode(), COLON.encode(), CLOSE.encode()]
        self.encoder = bpe.Encoder(spec_free)

    def turns(self, roles: list, texts: list) -> list[tuple[np.ndarray, int, int]]:
        """Per turn: its ids and where its text begins and ends among them."""
        role_ids, role_at = self.encoder.encode([escape(r, True) for r in roles])
        text_ids, text_at = self.encoder.encode([escape(t) for t in texts])
        out = []
        for i in range(len(roles)):
            parts = ([self.open], role_ids[role_at[i] : role_at[i + 1]], [self.colon],
                     text_ids[text_at[i] : text_at[i + 1]], [self.close])
            ends = np.cumsum([len(p) for p in parts])
            out.append((np.concatenate(parts).astype(np.int32), int(ends[2]), int(ends[3])))
        return out

    def text(self, ids: np.ndarray) -> str:
        return self.encoder.decode_bytes(ids).decode("utf-8")


def mask(n: int, role: str, start: int, end: int) -> np.ndarray:
    """1 for the tokens that count for the loss."""
    steps = np.zeros(n + 1, dtype=np.int8)
    if role == LOSS_ROLE:
        steps[start] += 1
        steps[end] -= 1
    return np.cumsum(steps[:n], dtype=np.int8)


_TEMPLATES: dict[int, Template] = {}


def _template(tokenizer: str) -> Template:
    key = hash(tokenizer)
    if key not in _TEMPLATES:
        _TEMPLATES.clear()
        _TEMPLATES[key] = Template(tokenizer)
    return _TEMPLATES[key]


SCHEMA = "conv_id {conv}, turn {turn}, role string, text string, ids array<int>, mask array<tinyint>, own_start long"


def format_turns(conversations: DataFrame, tokenizer_path: str, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per turn: conv_id, turn, role, text, ids, mask, token_start (its place in the conversation)."""
    spark = ready(conversations.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                                F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kinds = dict(rows.dtypes)
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("row")]  # row tells repeated turns apart
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("row")

    def assemble(batches):
        import pyarrow as pa

        template = _template(sent.value)
        now, passed = None, 0  # the conversation, and its tokens so far in this range
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            turns = template.turns(roles, texts)
            starts = []
            for conv, (ids, _, _) in zip(batch.column(0).to_pylist(), turns, strict=True):
                if now != (conv,):
                    now, passed = (conv,), 0
                starts.append(passed)
                passed += len(ids)
            offsets = pa.array(np.cumsum([0, *[len(x[0]) for x in turns]]).astype(np.int32))
            ids = np.concatenate([np.empty(0, dtype=np.int32), *[x[0] for x in turns]])
            masks = np.concatenate([np.empty(0, dtype=np.int8),
                                    *[mask(len(x[0]), r, x[1], x[2]) for x, r in zip(turns, roles, strict=True)]])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(ids)),
                 pa.ListArray.from_arrays(offsets, pa.array(masks)), pa.array(starts, pa.int64())],
                ["conv_id", "turn", "role", "text", "ids", "mask", "own_start"])

    made = rows.mapInArrow(assemble, SCHEMA.format(conv=kinds["conv_id"], turn=kinds["turn"]))
    made = staged(spark, made.withColumn("range", F.spark_partition_id()), "chat-turns")
    held = made.groupBy("conv_id", "range").agg(F.sum(F.size("ids").cast("long")).alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("before", F.sum("n").over(earlier)).filter("before is not null").select(  # of later ranges only
        F.col("conv_id").alias("of"), F.col("range").alias("in_range"), "before")
    before = staged(spark, before, "chat-ranges")
    placed = made.join(before, made["conv_id"].eqNullSafe(before["of"]) & (made["range"] == before["in_range"]), "left")
    return placed.select("conv_id", "turn", "role", "text", "ids", "mask",
                         (F.col("own_start") + F.coalesce("before", F.lit(0))).alias("token_start"))


def read_back(formatted: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per conversation what its tokens and masks say: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``formatted`` is what ``format_turns`` returns, in any order.
    """
    spark = formatted.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast(f.read())
    conv = dict(formatted.dtypes)["conv_id"]

    def decode(batches):
        """Every turn by itself, wherever it lies: its digest line, what counts for the loss, its length."""
        import pyarrow as pa

        template = _template(sent.value)
        for batch in batches:
            lines, losses, shown = [], [], []
            for ids, masked in zip(batch.column(2), batch.column(3), strict=True):
                ids = ids.values.to_numpy()
                text = template.text(ids)
                role, said = TURN.match(text).groups()
                lines.append(f"{unescape(role)}\n{unescape(said)}\n")
                losses.append(unescape(template.text(ids[masked.values.to_numpy().astype(bool)])))
                shown.append(len(text))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(lines, pa.string()), pa.array(losses, pa.string()), pa.array(shown, pa.int64())],
                                             ["conv_id", "token_start", "line", "loss", "shown"])

    def digest(batches):
        """The ordered turns of each conversation as one stream."""
        import pyarrow as pa

        now, state, done, kind = None, None, [], None

        def closed():
            turns, loss, n, chars, shown = state
            return (now[0], n, turns.hexdigest(), chars, loss.hexdigest(), shown)

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], type=kind), *[pa.array([r[i] for r in rows]) for i in range(1, 6)]],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            kind = batch.column(0).type
            for conv_id, line, loss, shown in zip(*[batch.column(i).to_pylist() for i in (0, 2, 3, 4)], strict=True):
                if now != (conv_id,):
                    if now is not None:
                        done.append(closed())
                    now, state = (conv_id,), [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                state[0].update(line.encode())
                state[1].update(loss.encode())
                state[2] += 1
                state[3] += len(loss)
                state[4] += shown
            if len(done) >= 1000:
                yield batch_of(done)
                done = []
        if now is not None:
            done.append(closed())
        if done:
            yield batch_of(done)

    decoded = formatted.select("conv_id", "token_start", "ids", "mask").mapInArrow(
        decode, f"conv_id {conv}, token_start long, line string, loss string, shown long")
    together = decoded.repartition("conv_id").sortWithinPartitions("conv_id", "token_start")
    return together.mapInArrow(
        digest, f"conv_id {conv}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


PROBE = "\\### Assistant: </turn> ok"


def op4_chat_format(spark, sf_dir):
    """All conversations and one of control strings, formatted and read back."""
    ready(spark)
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast(talks.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(talks.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(PROBE).alias("text"))
    path = bpe.tokenizer_file()
    return read_back(format_turns(talks.unionByName(probe), path), path)


_ESCAPED = "replace(replace(replace({0}, '\\', '\\\\'), '###', '\\###'), '</turn>', '\\</turn>')"
OP4_SQL = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, 'assistant', '{PROBE}')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(replace({_ESCAPED.format('role')}, ':', '\\:')) + length({_ESCAPED.format('text')})
                + {len(OPEN) + len(COLON) + len(CLOSE)}) as bigint) as formatted_chars
from rows group by conv_id"""
