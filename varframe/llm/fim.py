"""Fill-in-the-middle transformation: texts are cut at two unit ranks found by an indexable skip list.

A text is a row of units, by default its code points, else the matches of a pattern from
left to right, where each code point between two matches is a unit of its own. The units are
the bottom lane of a skip list; every ``FANOUT``-th node of a lane also stands in the lane
above it. A link carries two widths: the units and the code points it passes. Descending from
the top lane, a link is taken as long as the units passed stay within the rank, so the place
of a cut in code points is the sum of the second widths. The second cut goes on from the
first one's node.

Draws come from the hex sha256 of ``seed:id``: its first four groups of eight digits are
h1 to h4. The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units, the middle
after the larger, the suffix is the rest. A text stays plain if it is empty, holds one of the
marks, or h3 % 100 >= ``fim_percent``; otherwise it is written suffix first (spm) if
h4 % 100 < ``spm_percent``, else prefix first (psm). ``restored`` undoes it exactly: the marks
don't occur in the text and can't arise where its parts meet them.

Defined results: a null text is empty, so plain; a null id is drawn as an empty id; equal ids
are cut at the same ranks if their texts are equally long; repeated rows give repeated rows; an
empty table gives an empty result; very long texts are cut whole, a lane takes no memory beyond
the numbers of its nodes; other columns may have any name, they are kept in ``doc``.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ready, table, text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
FIM_PERCENT = 90
SPM_PERCENT = 20
SEED = 1
FANOUT = 16


class SkipList:
    """Lanes of links over units; ``widths`` are the units' widths in code points."""

    def __init__(self, widths: np.ndarray, fanout: int = FANOUT):
        self.units = len(widths)
        self.lanes = []
        units = np.broadcast_to(np.int64(1), self.units)
        while len(units) > fanout:
            self.lanes.append((units, widths))
            heads = np.arange(0, len(units), fanout)
            units, widths = (np.add.reduceat(x, heads, dtype=np.int64) for x in (units, widths))
        self.lanes.append((units, widths))
        self.fanout = fanout

    def seek(self, *ranks: int) -> list[int]:
        """The places in code points of the ascending ``ranks``."""
        found = []
        bottom = passed = at = 0  # a unit, which is also a rank; units and code points up to it
        for rank in ranks:
            # climb to the highest lane in which the last cut's node stands, then descend
            lane, node = 0, bottom
            while lane + 1 < len(self.lanes) and node % self.fanout == 0:
                lane, node = lane + 1, node // self.fanout
            while True:
                units, chars = self.lanes[lane]
                while node < len(units) and passed + units[node] <= rank:
                    passed, at, node = passed + int(units[node]), at + int(chars[node]), node + 1
                    if lane + 1 < len(self.lanes) and node % self.fanout == 0 and node < len(units):
                        lane, node = lane + 1, node // self.fanout
                        units, chars = self.lanes[lane]
                if lane == 0 or passed == rank:
                    break
                lane, node = lane - 1, node * self.fanout
            bottom = passed
            found.append(at)
        return found


def unit_widths(text: str, pattern: re.Pattern | None) -> np.ndarray:
    """Widths in code points of a text's units."""
    if pattern is None:
        return np.broadcast_to(np.int64(1), len(text))
    ends, done = [], 0
    for m in pattern.finditer(text):
        if m.end() > m.start():
            ends += [*range(done + 1, m.start() + 1), m.end()]
            done = m.end()
    ends += range(done + 1, len(text) + 1)
    return np.diff(np.array([0, *ends], dtype=np.int64))


def arranged(text: str, draws: tuple[int, int, int, int], pattern: re.Pattern | None, fim_percent: int, spm_percent: int):
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    widths = unit_widths(text, pattern)
    n = len(widths)
    h1, h2, h3, h4 = draws
    if not text or h3 % 100 >= fim_percent or any(m in text for m in MARKS):
        return n, "plain", None, None, text
    a, b = SkipList(widths).seek(*sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


RESULT = "n long, form string, prefix_chars long, middle_chars long, output string"


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str | None = None,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, seed: int = SEED) -> DataFrame:
    """``doc`` (all columns) with n (units), form, prefix_chars, middle_chars and the output text of every row.

    ``unit`` is a pattern of the ``re`` module for units other than code points.
    """
    ready(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[f"`{id_col}`"].cast("string"), F.lit(""))), 256)
    draw = lambda i: F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long")
    doc = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc")
    rows = docs.select(doc, F.array(*[draw(i) for i in range(4)]).alias("draws"))
    extra = StructType.fromDDL(RESULT)

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(extra)
        pattern = re.compile(unit) if unit is not None else None
        for batch in batches:
            doc, draws = batch.column(0), batch.column(1)
            texts = doc.field(doc.type.get_field_index(text_col))
            for lo, hi in text_slices(texts):
                made = [arranged(t or "", h, pattern, fim_percent, spm_percent) for t, h in
                        zip(texts.slice(lo, hi - lo).to_pylist(), draws.slice(lo, hi - lo).to_pylist(), strict=True)]
                arrays = [pa.array(c, type=f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([doc.slice(lo, hi - lo), *arrays], ["doc", *arrow.names])

    return rows.mapInArrow(run, StructType([rows.schema["doc"], *extra.fields]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    def between(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        head = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(head) + len(second) + 1)
        tail = F.substring_index(rest, MIDDLE, 1)
        return head, tail, F.substr(rest, F.length(tail) + len(MIDDLE) + 1)

    prefix, suffix, middle = between(PREFIX, SUFFIX)
    suffix_first, prefix_next, middle_last = between(SUFFIX, PREFIX)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(
        form == "spm", F.concat(prefix_next, middle_last, suffix_first)).otherwise(output)


def op13_fill_in_middle(spark, sf_dir):
    """The transformation of every document, as digests of its output and of the text restored from it."""
    ready(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(docs).select(
        "doc.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


OP13_SQL = f"""
with cut as (
  select doc_id, text, length(text) as n, h[1] as h1, h[2] as h2, h[3] as h3, h[4] as h4 from (
    select doc_id, coalesce(text, '') as text,
           list_transform([1, 9, 17, 25], lambda i: cast('0x' || substr(sha256(concat('{SEED}:', doc_id)), i, 8) as bigint)) as h
    from documents)),
formed as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when n = 0 or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}')
                or h3 % 100 >= {FIM_PERCENT} then 'plain' when h4 % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
  from cut),
parts as (
  select *, substr(text, 1, a) as p, substr(text, a + 1, b - a) as m, substr(text, b + 1) as s from formed)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then concat('{PREFIX}', p, '{SUFFIX}', s, '{MIDDLE}', m)
              else concat('{SUFFIX}', s, '{PREFIX}', p, '{MIDDLE}', m) end) as output_sha256,
       sha256(text) as restored_sha256
from parts"""
