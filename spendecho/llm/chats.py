r"""Conversations as training sequences in which shared first turns stand once.

Turns are formatted by a template and cut into ids of a public vocabulary. All
conversations together are a tree of turns: two are on the same node as long as role
and text of all turns so far are equal. The tree is laid out depth first: conversations
in the order of their paths, each giving the turns that the one before it does not
share. What one conversation gives is a segment.

    pack(turns) -> Packed
      pieces    a turn of a segment: place `start` in the stream of ids, `position` in its
                conversation, `tokens`, and the ids that carry loss, `loss_from` to `loss_to`
      segments  `start`, `length`, `position`, and `ancestors`: the intervals of the stream
                that its ids attend to besides the earlier ids of the segment itself
      members   the segment with which a conversation ends
    read(packed) -> role, text and loss text of each turn of each conversation, from ids
                 and intervals alone

Template: `<turn>`, role, line feed, text, `</turn>`, line feed. In role and text a
backslash is doubled and the `<` of either mark becomes `\l`; in a role a line feed
becomes `\n`. So no mark can come from a text, and reading back undoes exactly this.

A path is a list of 16-byte keys, one a turn: running combinations of the turns'
hashes with their places. Lists of keys are the most that is held of one conversation
at once; its texts stay rows, are sorted by ranges, and are hashed as they stream by.
The running combinations go by parts of a range sort, so a long conversation is spread
as well. The number of interval entries is at most that of the turns read.

Turns with equal numbers are ordered by role, then text, NULL numbers first; repeated
rows are turns each. NULL role or text counts as empty. Rows with a NULL id are one
conversation. Empty table: empty tables.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import discard, mapped, running_totals, small, written

OPEN, CLOSE = "<turn>", "</turn>"
LOSS_ROLE = "assistant"


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace(OPEN, "\\l" + OPEN[1:]).replace(CLOSE, "\\l" + CLOSE[1:])


def unescaped(text: str) -> str:
    plain = {"l": "<", "n": "\n", "\\": "\\"}
    return re.sub(r"\\(.)", lambda m: plain[m[1]], text)


def formatted(role: str, text: str) -> tuple[str, str, str]:
    """What stands before the text, the text, and what stands after it."""
    return OPEN + escaped(role).replace("\n", "\\n") + "\n", escaped(text), CLOSE + "\n"


def parsed(turn: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not (turn.startswith(OPEN) and turn.endswith(CLOSE + "\n")):
        raise ValueError("not a formatted turn")
    role, body = turn[len(OPEN) : -len(CLOSE) - 1].split("\n", 1)
    return unescaped(role), unescaped(body)


def vocabulary(path: str | None = None) -> tuple[str, dict[bytes, int]]:
    """Pattern and ranks of a byte-level vocabulary; `path` defaults to the installed public one."""
    import public_tokenizers

    lines = open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb")
    return public_tokenizers.PATTERN, {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoding(pattern: str, ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("turns", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _tokens(vocab):
    """Formats and encodes: (segment, place, key, role, text) to ids, loss interval and lengths."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(*vocab).encode_ordinary
        for batch in batches:
            ids, froms, tos, sizes = [], [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                head, body, tail = (encode(x) for x in formatted(role, text))
                loss = role == LOSS_ROLE
                ids.append(head + body + tail)
                froms.append(len(head) if loss else 0)
                tos.append(len(head) + len(body) if loss else 0)
                sizes.append(len(ids[-1]))
            new = [pa.array(ids, pa.list_(pa.int32())), *(pa.array(x, pa.int32()) for x in (froms, tos)), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *new], [*batch.schema.names[:3], "tokens", "loss_from", "loss_to", "size"])

    return run


@dataclass
class Packed:
    pieces: DataFrame
    segments: DataFrame
    members: DataFrame
    vocab: tuple[str, dict[bytes, int]]


def _running(rows: DataFrame, columns: dict, keep: list) -> DataFrame:
    """`columns` (running combinations, with what joins those of parts) over the rows of a
    conversation `conv` in order of `row`, part by part. A part passes on one row."""
    inside = Window.partitionBy("part", "conv").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    by_part = rows.groupBy("conv", "part").agg(*[total.alias(f"_from_{c}") for c, (total, _) in columns.items()])
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    split = by_part.groupBy("conv").agg(F.count("*").alias("_n")).filter("_n > 1").select("conv")  # some a part
    offsets = by_part.join(split, "conv").select("conv", "part", *[_over(c, earlier) for c in columns])
    joined = rows.withColumns({c: total.over(inside) for c, (total, _) in columns.items()})
    joined = joined.join(small(written(offsets, "chat-offsets")), ["conv", "part"], "left")
    return joined.select(*keep, *[joined_by(F.col(c), F.coalesce(F.col(f"_from_{c}"), F.lit(0))).alias(c) for c, (_, joined_by) in columns.items()])


def _over(c: str, window) -> Column:
    name = f"_from_{c}"
    return (F.sum(name) if c == "n" else F.bit_xor(name)).over(window).alias(name)


def pack(turns: DataFrame, vocab: tuple[str, dict[bytes, int]] | None = None) -> Packed:
    """`turns` (conv_id, turn, role, text) as a depth-first stream."""
    vocab = vocab or vocabulary()
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    rows = turns.select("conv_id", conv.alias("conv"), "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    rows = rows.orderBy("conv", F.col("turn").asc_nulls_first(), "role", "text").withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "chat-turns")

    # Place of each turn, then the key of each path that ends with it.
    narrow = rows.select("conv", "row", F.shiftright("row", 33).alias("part"), F.xxhash64("role", "text").alias("_h"), F.xxhash64("text", F.lit(1), "role").alias("_g"))
    numbered = _running(narrow, {"n": (F.count(F.lit(1)), lambda a, b: a + b)}, ["conv", "row", "part", "_h", "_g"])
    salted = written(numbered.select("conv", "row", "part", "n", F.xxhash64("_h", "n").alias("_a"), F.xxhash64("n", "_g").alias("_b")), "chat-places")
    keys = {c: (F.bit_xor(f"_{c}"), lambda x, y: x.bitwiseXOR(y)) for c in ("a", "b")}
    keyed = _running(salted.withColumnRenamed("n", "i"), keys, ["conv", "row", "i"])
    keyed = written(keyed, "chat-keys")

    # Distinct conversations in the order of their paths, and what each shares with the one before.
    path = F.transform(F.sort_array(F.collect_list(F.struct("i", "a", "b"))), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))
    paths = written(keyed.groupBy("conv").agg(path.alias("path")).withColumn("end", F.element_at("path", -1)), "chat-paths")
    distinct = paths.groupBy("end", F.size("path").alias("turns")).agg(F.min("conv").alias("conv"), F.first("path").alias("path"))
    ordered = written(distinct.orderBy("path").withColumn("segment", F.monotonically_increasing_id()), "chat-ordered")
    ordered_in = ordered.withColumn("part", F.shiftright("segment", 33))
    last = ordered_in.groupBy("part").agg(F.max_by("path", "segment").alias("_last"))  # a row a part
    last = last.select("part", F.lag("_last").over(Window.orderBy("part")).alias("_last"))
    before = F.lag("path").over(Window.partitionBy("part").orderBy("segment"))
    shared = F.expr("array_position(zip_with(path, before, (x, y) -> coalesce(x = y, false)), false) - 1")
    shared = F.when(F.col("before").isNull(), 0).otherwise(shared)
    laid = ordered_in.withColumn("before", before).join(F.broadcast(last), "part")
    laid = laid.withColumn("before", F.coalesce("before", "_last")).withColumn("shared", shared.cast("long"))
    laid = written(laid.select("segment", "conv", "turns", "end", "path", "shared"), "chat-segments")

    # The turns a segment gives itself, and their ids.
    steps = laid.select("segment", "conv", "shared", F.posexplode("path").alias("at", "key"))
    steps = steps.select("segment", "conv", "shared", F.col("at").cast("long").alias("at"), "key")
    own = steps.filter("at >= shared").join(keyed.select("conv", (F.col("i") - 1).alias("at"), "row"), ["conv", "at"])
    texts = own.select("segment", "at", "key", "row").join(rows.select("row", "role", "text"), "row").select("segment", "at", "key", "role", "text")
    made = written(mapped(texts, _tokens(vocab), "segment long, at long, key struct<a: long, b: long>, tokens array<int>, loss_from int, loss_to int, size long"), "chat-tokens")
    placed = running_totals(made.select("segment", "at", "key", "size"), [F.col("segment"), F.col("at")], {"start": F.col("size")}, "chat-sorted")
    placed = written(placed, "chat-placed")

    # Intervals of the stream before each segment, one for each earlier segment on its path.
    above = steps.filter("at < shared").select("segment", "at", "key")
    met = above.join(placed.select("at", "key", F.col("segment").alias("of"), "start", "size"), ["at", "key"])
    spans = met.groupBy("segment", "of").agg(F.min("at").alias("from"), F.max("at").alias("to"), F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"))
    ancestors = spans.groupBy("segment").agg(
        F.sort_array(F.collect_list(F.struct("from", "to", "of", "start", "end"))).alias("ancestors"), F.sum(F.col("end") - F.col("start")).alias("position")
    )
    lengths = placed.groupBy("segment").agg(F.min("start").alias("start"), F.sum("size").alias("length"), F.min("at").alias("from"), F.max("at").alias("to"))
    none = F.array().cast(ancestors.schema["ancestors"].dataType)
    ends = laid.select("segment", "turns", "end").join(lengths, "segment", "left").join(ancestors, "segment", "left")
    segments = ends.select(
        "segment", "turns", "end", "start", F.coalesce("length", F.lit(0)).alias("length"), F.coalesce("position", F.lit(0)).alias("position"),
        "from", "to", F.coalesce("ancestors", none).alias("ancestors"),
    )
    segments = written(segments, "chat-tree")
    base = segments.select("segment", F.col("start").alias("_start"), F.col("position").alias("_position"))
    at = placed.select("segment", "at", "start").join(base, "segment")
    at = at.select("segment", "at", "start", (F.col("_position") + F.col("start") - F.col("_start")).alias("position"))
    pieces = made.drop("key").join(at, ["segment", "at"])
    pieces = written(pieces, "chat-pieces")
    ids = rows.groupBy("conv").agg(F.first("conv_id").alias("conv_id"))
    ended = paths.select("conv", "end", F.size("path").alias("turns")).join(segments.select("segment", "end", "turns"), ["end", "turns"])
    members = written(ended.select("conv", "segment", "turns").join(ids, "conv").drop("conv"), "chat-members")
    discard(salted, keyed, paths, ordered, laid, made, placed, rows)
    return Packed(pieces, segments.drop("end"), members, vocab)


def _decoded(vocab):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoding(*vocab).decode_bytes
        for batch in batches:
            roles, texts, losses, sizes = [], [], [], []
            tokens, bounds = batch.column("tokens").to_pylist(), zip(batch.column("loss_from").to_pylist(), batch.column("loss_to").to_pylist())
            for ids, (a, b) in zip(tokens, bounds):
                turn = decode(ids).decode()
                role, text = parsed(turn)
                roles.append(role), texts.append(text), sizes.append(len(turn))
                losses.append(unescaped(decode(ids[a:b]).decode()) if b > a else None)
            new = [pa.array(x, pa.string()) for x in (roles, texts, losses)] + [pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *new], [*batch.schema.names[:4], "role", "text", "loss", "chars"])

    return run


def read(packed: Packed) -> DataFrame:
    """(segment, at, role, text, loss, chars) of every turn on the way to each segment's end:
    the ids in its ancestors' intervals, then its own."""
    cut = packed.pieces.select("segment", "at", "start", F.size("tokens").cast("long").alias("size"), "tokens", "loss_from", "loss_to")
    turns = mapped(cut, _decoded(packed.vocab), "of long, at long, start long, size long, role string, text string, loss string, chars long")
    own = F.struct("from", "to", F.col("segment").alias("of"), "start", (F.col("start") + F.col("length")).alias("end"))
    spans = packed.segments.withColumn("spans", F.when(F.col("length") > 0, F.concat("ancestors", F.array(own))).otherwise(F.col("ancestors")))
    spans = spans.select("segment", F.inline("spans"))
    wanted = spans.select("segment", "of", F.explode(F.sequence("from", "to")).alias("at"), F.col("start").alias("_from"), F.col("end").alias("_to"))
    found = wanted.join(turns, ["of", "at"]).filter("start >= _from AND start + size <= _to")
    return found.select("segment", "at", "role", "text", "loss", "chars")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the turns of each segment, which come in order; one turn is held at a time."""
    names = ["segment", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, n, chars, lost, whole, loss = None, 0, 0, 0, None, None

    def done(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

    for batch in batches:
        out = []
        for segment, role, text, learned, size in zip(*(batch.column(c).to_pylist() for c in ("segment", "role", "text", "loss", "chars"))):
            if segment != now:
                if now is not None:
                    out.append((now, n, whole.hexdigest(), lost, loss.hexdigest(), chars))
                now, n, chars, lost, whole, loss = segment, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
            n, chars = n + 1, chars + size
            whole.update(f"{role}\n{text}\n".encode())
            if learned is not None:
                lost += len(learned)
                loss.update(learned.encode())
        yield done(out)
    if now is not None:
        yield done([(now, n, whole.hexdigest(), lost, loss.hexdigest(), chars)])


def digest(packed: Packed) -> DataFrame:
    """Per conversation, what reading it back gives."""
    turns = read(packed).repartition("segment").sortWithinPartitions("segment", "at")
    kinds = "segment long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    found = written(mapped(turns, _digests, kinds), "chat-digests")
    return packed.members.select("conv_id", "segment").join(found, "segment").drop("segment")
