"""Conversation structure repair: the cheapest edits that give a well-formed sequence of turns.

Turns of a conversation go by turn number, nulls first; turns of one number by role and by the SHA-256 of
their text. Every turn has at most one fault, the first of these: *blank* (no character outside
``[\\x20\\x09-\\x0D]``), *duplicate* (role and text were there before), *truncated* (its last such character
is not one of ``.!?``). A repaired conversation has role initials ``(s?(ua)+)?``. Edits: Keep (0), Rerole to
user or assistant (3), Delete (4; a must for blank and duplicate turns), Insert an empty user or assistant
turn (3); a truncated turn that stays costs 3 more. Of the cheapest edits those with the least string of
initials are taken (``auction.py``: auction shortest paths over the lattice of rows and states).

The turns are written once. Only one code a turn goes to the sort by conversation, where each conversation
streams through its task with about 30 bytes a turn; the texts meet the edits by row number and are sorted
by place in the repaired conversation, and the hash of a conversation is computed as they stream by, so no
conversation is ever held whole with its texts. A conversation is one sequence with one hash, so its codes
do pass through one task.

Defined results: a null role or text counts as one space; turns without a turn number come first and are
not counted in gaps; a null conv_id is a conversation of its own; repeated rows are duplicates; a role of
no known initial can only be reroled or deleted; a conversation whose turns are all ``dropped`` has zeros,
an empty audit and the hash of the empty string. An empty table gives an empty result. Columns other than
conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import auction as A
from .common import Scratch

WHITE = " \t\n\x0b\x0c\r"
_ROLES = {A.USER: "user", A.ASSISTANT: "assistant"}
_LAWFUL = np.zeros((4, 4), bool)
_LAWFUL[[A.SYSTEM, A.USER, A.ASSISTANT], [A.USER, A.ASSISTANT, A.USER]] = True
#: A dropped turn in the stream of codes: it only tells that its conversation is there.
_DROPPED = 127
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_MOST = (1 << 63) - 1


def damage(rows: DataFrame) -> DataFrame:
    """The rows with faults that crc32 of ``conv_id:turn`` chooses, and ``dropped``: of 20 values 0 drops
    the row, 1 empties its text, 2 removes ``.!?``, 3 repeats the row, 4 makes it a user's."""
    text_or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    x = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), text_or_space("role").alias("role"), text_or_space("text").alias("text"),
        (F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn")).cast("binary")) % 20).alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    x = x.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), F.explode(times).alias("copy"))
    return x.drop("copy")


class Repaired(NamedTuple):
    summary: DataFrame  # conv_id, the counts, cost, audit, repaired_sha256
    turns: DataFrame  # conv_id, place, role, text of the repaired conversations


def _codes(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, row_id, code) of all rows."""
    again = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", "dropped").orderBy(F.col("turn").asc_nulls_first(), "row_id")) > 1
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(F.col("blank"), A.BLANK).when(again, A.DUPLICATE).when(F.col("cut"), A.TRUNCATED).otherwise(A.FINE)
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", A.SYSTEM).when(first == "u", A.USER).when(first == "a", A.ASSISTANT).otherwise(A.OTHER)
    x = rows.select(
        "conv_id", "turn", "role", "row_id", "dropped", F.unhex(F.sha2("text", 256)).alias("digest"), (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    return x.select("conv_id", "turn", "role", "digest", "row_id", F.when(F.col("dropped"), _DROPPED).otherwise(4 * fault + role).cast("tinyint").alias("code"))


def _counted(turn: list[int | None], codes: np.ndarray) -> list[int]:
    known = [t for t in turn if t is not None]  # in order
    gaps = known[-1] - known[0] + 1 - (1 + sum(a != b for a, b in zip(known, known[1:], strict=False))) if known else 0
    faults = np.bincount(codes >> 2, minlength=4)
    roles = codes & 3
    illegal = int((~_LAWFUL[roles[:-1], roles[1:]]).sum())
    return [min(gaps, _MOST), int(faults[A.BLANK]), int(faults[A.DUPLICATE]), int(faults[A.TRUNCATED]), illegal]


def _edit(conv_type):
    """Function over batches of ordered codes: a summary (place -1) and the repaired turns of each conversation."""
    schema = pa.schema([("conv_id", conv_type), ("place", pa.int64()), ("row_id", pa.int64()), ("new_role", pa.string()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])

    fresh = lambda: {n: [] for n in schema.names}

    def finish(conv, parts: list[tuple]):
        """Summary and turns of one conversation, as rows."""
        codes = np.concatenate([p[2] for p in parts])
        here = codes != _DROPPED
        turn = [t for p in parts for t in p[0]]
        turn = [t for t, h in zip(turn, here.tolist(), strict=True) if h]
        rows, codes = np.concatenate([p[1] for p in parts])[here], codes[here]
        raw = codes.astype(np.uint8).tobytes()
        audit, cost = A.cheapest(raw)
        yield conv, -1, None, None, *_counted(turn, codes), cost, audit
        for k, (i, role) in enumerate(A.outcome(raw, audit)):
            yield conv, k, int(rows[i]) if i >= 0 else None, _ROLES.get(role), *[None] * len(_COUNTS), None

    def conversations(batches):
        conv, parts = None, []
        for b in batches:
            convs, turns = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows, codes = b.column(2).to_numpy(), b.column(3).to_numpy()
            n = len(convs)
            starts = [k for k in range(n) if k == 0 or convs[k] != convs[k - 1]]
            for s, e in zip(starts, [*starts[1:], n], strict=True):
                if parts and convs[s] != conv:
                    yield from finish(conv, parts)
                    parts = []
                conv = convs[s]
                parts.append((turns[s:e], rows[s:e], codes[s:e]))
        if parts:
            yield from finish(conv, parts)

    def run(batches):
        out = fresh()
        for row in conversations(batches):
            for name, v in zip(schema.names, row, strict=True):
                out[name].append(v)
            if len(out["place"]) == 10_000:
                yield pa.RecordBatch.from_pydict(out, schema)
                out = fresh()
        yield pa.RecordBatch.from_pydict(out, schema)

    return run


def _hash(conv_type):
    """Function over batches of summaries (place -1) and repaired turns in order: the summary with the hash."""
    schema = pa.schema([("conv_id", conv_type), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def run(batches):
        row, digest = None, None
        for b in batches:
            out: dict[str, list] = {n: [] for n in schema.names}
            place, line = b.column("place").to_pylist(), b.column("line").to_pylist()
            at = [k for k, p in enumerate(place) if p < 0]
            heads = dict(zip(at, b.drop_columns(["place", "line"]).take(pa.array(at, pa.int32())).to_pylist(), strict=True))
            for k, p in enumerate(place):
                if p < 0:
                    give(out, row, digest)
                    row, digest = heads[k], hashlib.sha256()
                else:
                    digest.update((b"\n" if p else b"") + line[k].encode())
            yield pa.RecordBatch.from_pydict(out, schema)
        out = {n: [] for n in schema.names}
        give(out, row, digest)
        yield pa.RecordBatch.from_pydict(out, schema)

    def give(out, row, digest):
        if row is not None:
            for n, v in (row | {"repaired_sha256": digest.hexdigest()}).items():
                out[n].append(v)

    return run


def repair(spark: SparkSession, rows: DataFrame) -> Repaired:
    """Repair every conversation of ``rows`` (conv_id, turn, role, text; ``dropped`` if there is such a flag)."""
    from pyspark.sql.pandas.types import to_arrow_type

    scratch = Scratch(spark, "conversations", broadcast=False)
    dropped = F.coalesce(F.col("dropped"), F.lit(False)) if "dropped" in rows.columns else F.lit(False)
    text_or_space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    kept = scratch.write(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), text_or_space("role"), text_or_space("text"), dropped.alias("dropped"), F.monotonically_increasing_id().alias("row_id")), "rows", "zstd")
    kind = kept.schema["conv_id"].dataType
    ddl = f"conv_id {kind.simpleString()}"
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    order = _codes(kept).repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "digest", "row_id")
    edits = order.select("conv_id", "turn", "row_id", "code").mapInArrow(_edit(to_arrow_type(kind)), f"{ddl}, place long, row_id long, new_role string, {counts}, audit string")
    edits = scratch.write(edits, "edits")
    turns = edits.where("place >= 0").join(kept.select("row_id", "role", "text"), "row_id", "left").select("conv_id", "place", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    heads = edits.where("place < 0").select("conv_id", "place", F.lit(None).cast("string").alias("line"), *_COUNTS, "audit")
    lines = turns.select("conv_id", "place", F.concat("role", F.lit(":"), "text").alias("line"), *[F.lit(None).cast("long").alias(c) for c in _COUNTS], F.lit(None).cast("string").alias("audit"))
    order = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return Repaired(order.mapInArrow(_hash(to_arrow_type(kind)), f"{ddl}, {counts}, audit string, repaired_sha256 string"), turns)
