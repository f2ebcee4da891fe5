"""Chat formatting of reply trees.

Messages form trees (a message names its parent within its conversation).
Root-to-leaf paths are enumerated by iterative self-joins with doubling: round
k joins the path entries with the 2^k-th ancestors, so a thread of n turns
takes log2(n) rounds, and the joins carry ids only.  Branches are ranked by
their mean score; each chosen path is formatted as one conversation.

The template marks a turn as ``<|turn|>role \\n text <|end|> \\n`` (without the
blanks).  Inside roles and texts a backslash is doubled and every control
string (the template's own and common ones of other templates) gets a
backslash behind its first character, so that no control string is left in
them; ``\\(.)`` -> ``\\1`` undoes both.  The loss mask covers the assistant texts.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import drop_tables, is_empty, materialize, read_table

TURN, END = "<|turn|>", "<|end|>"
#: Control strings that texts must not contain literally.
CONTROLS = [TURN, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>",
            "<|start_header_id|>", "<|end_header_id|>", "<|begin_of_text|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>",
            "<</SYS>>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>"]
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(.)", re.S)
_HEAD = re.compile(r"((?:[^\\\n]|\\.)*)\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans (code points) under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head = TURN + escape(role).replace("\n", "\\\n") + "\n"
        body = escape(text)
        out += [head, body, END + "\n"]
        at += len(head)
        if role == learn:
            spans.append((at, at + len(body)))
        at += len(body) + len(END) + 1
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(TURN, at):
            raise ValueError(f"no turn at {at}")
        head = _HEAD.match(formatted, at + len(TURN))
        end = formatted.index(END + "\n", head.end())
        turns.append((unescape(head.group(1)), unescape(formatted[head.end():end])))
        at = end + len(END) + 1
    return turns


def reply_paths(nodes: DataFrame) -> DataFrame:
    """(conv, leaf, node, dist) for every message of every root-to-leaf path.

    ``nodes``: conv, id, parent.  dist counts the steps up from the leaf.  A
    message whose parent is null or missing is a root; paths that reach no
    root (cycles) are left out.
    """
    nodes = materialize(nodes.select("conv", "id", "parent"), "nodes")
    up = materialize(nodes.join(nodes.select("conv", F.col("id").alias("parent")), ["conv", "parent"])
                     .select("conv", F.col("id").alias("node"), F.col("parent").alias("above")), "up")
    roots = materialize(nodes.select("conv", F.col("id").alias("node")).join(up, ["conv", "node"], "left_anti"), "roots")
    paths = nodes.join(up.select("conv", F.col("above").alias("id")), ["conv", "id"], "left_anti").select(
        "conv", F.col("id").alias("leaf"), F.col("id").alias("node"), F.lit(0).cast("long").alias("dist"))
    paths = materialize(paths, "paths")
    step, longest = 1, nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    while step < longest:  # a path has no more messages than its conversation
        new = materialize(paths.join(up, ["conv", "node"]).select(
            "conv", "leaf", F.col("above").alias("node"), (F.col("dist") + step).alias("dist")), "paths")
        if is_empty(new):
            break
        # written once: a plan that grows by every earlier round would be planned again for each use
        before = (paths, new)
        paths, step = materialize(paths.unionByName(new), "paths"), 2 * step
        drop_tables(*before)
        if step < longest:
            up = materialize(up.join(up.select("conv", F.col("node").alias("above"), F.col("above").alias("next")), ["conv", "above"])
                             .select("conv", "node", F.col("next").alias("above")), "up")
    rooted = materialize(paths.join(roots, ["conv", "node"], "left_semi").select("conv", "leaf"), "rooted")
    out = materialize(paths.join(rooted, ["conv", "leaf"], "left_semi"), "paths")
    drop_tables(paths, rooted, roots, up)
    return out


FORMATTED = "conv_id {conv}, leaf {id}, rank long, score double, formatted string, loss_spans array<struct<start:long,end:long>>"


def format_trees(messages: DataFrame, conv: str = "conv_id", msg: str = "msg_id", parent: str = "parent_id", role: str = "role",
                 text: str = "text", score: str | None = None, top: int | None = None) -> DataFrame:
    """One row per chosen path: conv_id, leaf, rank, score, formatted, loss_spans.

    Paths of a conversation are ranked by the mean score of their messages
    (null: 0; ties: smaller leaf first) and the best ``top`` (all by default)
    are formatted.  A null role or text is empty, a null conversation id is a
    conversation of its own; rows with a null message id are left out.  Of rows
    that repeat (conversation, message) the first by parent, role and text
    counts.  Other columns are not read.
    """
    null = F.col(conv).isNull()
    rows = messages.where(F.col(msg).isNotNull()).select(
        F.struct(null.alias("null"), F.col(conv).alias("id")).alias("conv"), F.col(msg).alias("id"), F.col(parent).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(F.col(score) if score else F.lit(None), F.lit(0)).cast("double").alias("score"))
    # joins on a null key match nothing: a null conversation is the struct (true, null) under a plain key
    rows = rows.withColumn("conv", F.struct(F.col("conv.null").alias("null"), F.coalesce(F.col("conv.id").cast("string"), F.lit("")).alias("key")))
    keep = F.min(F.struct(F.col("parent").isNull().alias("root"), "parent", "role", "text", "score")).alias("m")
    rows = materialize(rows.groupBy("conv", "id").agg(keep).select("conv", "id", "m.parent", "m.role", "m.text", "m.score"), "messages")
    paths = reply_paths(rows)
    scored = paths.join(rows.select("conv", F.col("id").alias("node"), "score"), ["conv", "node"]) if score else paths.withColumn("score", F.lit(0.0))
    best = scored.groupBy("conv", "leaf").agg(F.avg("score").alias("score"))
    best = best.withColumn("rank", F.row_number().over(W.partitionBy("conv").orderBy(F.desc("score"), "leaf")).cast("long"))
    if top is not None:
        best = best.where(F.col("rank") <= top)
    turns = (paths.join(best, ["conv", "leaf"]).join(rows.select("conv", F.col("id").alias("node"), "role", "text"), ["conv", "node"])
             .groupBy("conv", "leaf", "rank", "score")
             .agg(F.sort_array(F.collect_list(F.struct(F.negative("dist").alias("at"), "role", "text"))).alias("turns")))
    kinds = {"conv": messages.schema[conv].dataType.simpleString(), "id": messages.schema[msg].dataType.simpleString()}
    plain = turns.select(F.when(F.col("conv.null"), F.lit(None)).otherwise(F.col("conv.key")).cast(kinds["conv"]).alias("conv_id"),
                         "leaf", "rank", "score", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def rows_of(batches):
        for b in batches:
            done = [format_turns(list(zip(r, t, strict=True))) for r, t in zip(b.column("roles").to_pylist(), b.column("texts").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array([f for f, _ in done], pa.string()),
                 pa.array([[{"start": s, "end": e} for s, e in x] for _, x in done], spans)],
                ["conv_id", "leaf", "rank", "score", "formatted", "loss_spans"])

    return plain.mapInArrow(rows_of, FORMATTED.format(**kinds))


def threads(turns: DataFrame) -> DataFrame:
    """Conversations given as rows by turn, as trees without branches: msg_id and
    parent_id are numbered by (turn, role, text) within the conversation."""
    n = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text"))
    return turns.withColumn("msg_id", n).withColumn("parent_id", F.when(F.col("msg_id") > 1, F.col("msg_id") - 1))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of conversation -1, read back from the formatted text."""
    probe = "</s>[INST] ok [/INST]"
    turns = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    added = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    done = format_trees(threads(turns.unionByName(added)))

    def rows(batches):
        for b in batches:
            out = []
            for conv, text, spans in zip(b.column("conv_id").to_pylist(), b.column("formatted").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
                read = parse_turns(text)
                loss = "".join(unescape(text[s["start"]:s["end"]]) for s in spans)
                out.append((conv, len(read), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in read).encode()).hexdigest(),
                            len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return done.select("conv_id", "formatted", "loss_spans").mapInArrow(
        rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_SQL_CONTROLS = "|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True))

OP3_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, length(regexp_replace(replace(text, '\', '\\'), '({_SQL_CONTROLS})', '\1~', 'g')) AS text_chars,
    length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\' || chr(10)), '({_SQL_CONTROLS})', '\1~', 'g')) AS role_chars
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
    sum(role_chars + text_chars + {len(TURN) + len(END) + 2})::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g
"""
