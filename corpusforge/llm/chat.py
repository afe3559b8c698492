"""Operator 4, chat formatting: prefix trees of conversations.

Conversations that share their initial turns share a path in a tree whose
nodes are turns.  A tree becomes one sequence: every node's tokens stand there
once, depth first.  A token's position id counts along its own path, and its
node's attention intervals are the stretches of the sequence that its path
takes up, so each conversation sees exactly its own turns.

The template writes a turn as ``### role: text</turn>`` and a line feed.  A
backslash goes before every backslash and before every ``### `` and ``</turn>``
inside a text (and before a colon inside a role), so an unescaped marker always
is one, and unescaping gives the text back.  Only assistant texts are under the
loss mask.  Tokens are those of a byte-level BPE; role, text and end mark are
encoded apart, so equal turns have equal tokens whatever stands around them.

Scale: a sequence holds the conversations of a first turn.  Where more than
``TREE`` conversations share a path of turns, they part at the next turn:
conversations that share that one too stay together, and as many of these groups as
make up about ``TREE`` conversations become a sequence, which holds the turns
above them once.  Only conversations equal in all turns are dealt by
their id.  So neither a task nor a sequence is unbounded, and a turn is emitted
again at most once for every ``TREE`` conversations that share it.  Paths are
counted by hashes, made before anything is shuffled; sequences are built while a sorted
partition streams by.  The unit that is held whole is a conversation, and a
tree of about ``TREE`` of them.

Defined results: turns go by ``turn`` (null first), then role and text, and
equal rows are turns of their own; a null text or role is empty; rows without
conv_id are one conversation; extra columns are not read; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm import encode
from corpusforge.operators.plan_utils import materialize

TREE = 512  # conversations in a sequence, about
LEARNED_ROLE = "assistant"
OPEN, END = "### ", "</turn>"

SPECIAL_TEXT = re.compile(r"\\|### |</turn>")
SPECIAL_ROLE = re.compile(r"\\|### |</turn>|:")
ESCAPED = re.compile(r"\\(\\|### |</turn>|:)")
TURN = re.compile(r"### ((?:\\.|[^\\:])*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)


def escape(text: str, special: re.Pattern = SPECIAL_TEXT) -> str:
    return special.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1], text)


def render(role: str, text: str) -> tuple[str, str, str]:
    """A turn's three parts; the middle one is its text."""
    return f"{OPEN}{escape(role, SPECIAL_ROLE)}: ", escape(text), f"{END}\n"


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    found, at = [], 0
    while at < len(formatted):
        m = TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a turn at {at}")
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return found


#: A sequence: its tokens and their position ids; per node (turn) its parent's number, place and loss span, and the range of its
#: attention intervals in ``attend_start`` and ``attend_end``; per conversation its id, number of turns and last node.
SEQUENCE = ("tree string, input_ids array<int>, position_ids array<int>, parent array<int>, start array<int>, end array<int>, "
            "loss_start array<int>, loss_end array<int>, attend_from array<int>, attend_to array<int>, attend_start array<int>, attend_end array<int>, "
            "conv_id array<string>, n_turns array<int>, leaf array<int>")
NAMES = [x.split()[0] for x in SEQUENCE.split(", ")]
BATCH = 64  # sequences handed to Spark at once


class Tree:
    """Turns as nodes in depth-first order with their place in the sequence."""

    def __init__(self, conversations: list[tuple[str | None, list[tuple[str, str]]]], path: str):
        children: list[dict[tuple[str, str], int]] = [{}]
        label: list[tuple[str, str]] = [("", "")]
        leaf: list[int] = []
        for _, turns in conversations:
            at = 0
            for turn in turns:
                if turn not in children[at]:
                    children[at][turn] = len(label)
                    children.append({})
                    label.append(turn)
                at = children[at][turn]
            leaf.append(at)
        self.ids: list[np.ndarray] = []
        self.positions: list[np.ndarray] = []
        nodes: list[tuple] = []  # in the order of SEQUENCE, from parent to attend_to
        spans: list[tuple[int, int]] = []
        number, size = {}, 0
        stack = [(k, -1, 0, []) for k in reversed(children[0].values())]
        while stack:
            k, parent, position, attends = stack.pop()
            parts = [encode.encode(path, x) for x in render(*label[k])]
            lengths = [len(x) for x in parts]
            n, at = sum(lengths), size + lengths[0]
            loss = (at, at + lengths[1]) if label[k][0] == LEARNED_ROLE else (size, size)
            # the parent's intervals and its own, joined where one goes on from the other
            attends = [*attends[:-1], (attends[-1][0], size + n)] if attends and attends[-1][1] == size else [*attends, (size, size + n)]
            number[k] = len(nodes)
            nodes.append((parent, size, size + n, *loss, len(spans), len(spans) + len(attends)))
            spans += attends
            self.ids += parts
            self.positions.append(np.arange(position, position + n, dtype=np.int32))
            stack += [(c, number[k], position + n, attends) for c in reversed(children[k].values())]
            size += n
        self.columns = [*np.array(nodes, np.int32).reshape(-1, 7).T, *np.array(spans, np.int32).reshape(-1, 2).T]
        self.members = [[c for c, _ in conversations], [len(t) for _, t in conversations], [number.get(x, -1) for x in leaf]]

    def row(self, tree: str) -> tuple:
        return tree, np.concatenate(self.ids).astype(np.int32), np.concatenate(self.positions), *self.columns, *self.members


def attention_intervals(row, node: int) -> list[tuple[int, int]]:
    """The stretches of a sequence that a node's tokens may attend to (its ancestors and, causally, itself)."""
    at = range(row.attend_from[node], row.attend_to[node])
    return [(row.attend_start[k], row.attend_end[k]) for k in at]


def _builder(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Over a partition sorted by tree, conversation and turn."""
        key, held, out = None, [], []
        rows = chain.from_iterable(pdf.itertuples(index=False) for pdf in batches)
        for r in chain(rows, [None]):
            if held and (r is None or r.tree != key):
                out.append(Tree([(c[1:] if c[0] == ID else None, turns) for c, turns in held], path).row(key))
                held = []
            if len(out) == BATCH or r is None:
                yield pd.DataFrame(out, columns=NAMES)
                out = []
            if r is not None:
                key = r.tree
                if not held or held[-1][0] != r.conv:
                    held.append((r.conv, []))
                held[-1][1].append((r.role, r.text))

    return run


ID, NO_ID = "c", "n"  # what a conversation's key begins with: its id follows, or it has none


def keyed_turns(turns: DataFrame) -> DataFrame:
    """``conv`` (a key without nulls), ``turn, role, text``."""
    conv = F.coalesce(F.concat(F.lit(ID), turns["conv_id"].cast("string")), F.lit(NO_ID))
    text = lambda c: F.coalesce(turns[c].cast("string"), F.lit("")).alias(c)
    return turns.select(conv.alias("conv"), turns["turn"].alias("turn"), text("role"), text("text"))


def deal(turns: DataFrame, tree: int = TREE) -> DataFrame:
    """``conv, tree``: the sequence that each conversation goes to.  Reads hashes of the turns only."""
    hashed = turns.select("conv", "turn", F.xxhash64("role", "text").alias("h"))
    convs = hashed.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("turn", "h"))).alias("turns"))
    step = lambda path, t: F.concat(path, F.array(F.xxhash64(F.coalesce(F.get(path, F.size(path) - 1), F.lit(0)), t["h"])))
    convs = materialize(convs.select("conv", F.aggregate("turns", F.array().cast("array<bigint>"), step).alias("paths")), "paths")
    each = convs.select("conv", F.posexplode("paths").alias("depth", "path"))
    # written, so that Spark knows the size of the side with few rows
    hot = materialize(each.groupBy("path").agg(F.count("*").alias("n")).filter(F.col("n") > tree).select("path"), "hot-paths")
    deepest = each.join(hot, "path").groupBy("conv").agg(F.max("depth").alias("depth"), F.max_by("path", "depth").alias("hot"))
    found = convs.join(deepest, "conv", "left")
    # together with the conversations that share the next turn too
    found = found.select("conv", F.get("paths", F.lit(0)).alias("first"), "hot", F.coalesce(F.get("paths", F.col("depth") + 1), F.xxhash64("conv")).alias("next"))
    found = materialize(found, "deepest-paths")
    parts = materialize(found.filter("hot IS NOT NULL").groupBy("hot").agg(F.ceil(F.count("*") / tree).alias("parts")), "parts").withColumnRenamed("hot", "h")
    part = F.pmod(F.xxhash64("next"), F.col("parts"))
    return found.join(parts, F.col("hot") == F.col("h"), "left").select("conv", F.when(F.col("h").isNotNull(), F.concat_ws("-", F.lit("hot"), F.col("h"), part)).otherwise(F.col("first").cast("string")).alias("tree"))


def prefix_trees(turns: DataFrame, path: str | None = None, tree: int = TREE) -> DataFrame:
    """One row per sequence, see :data:`SEQUENCE`."""
    turns = keyed_turns(turns)
    rows = turns.join(deal(turns, tree), "conv").repartition("tree").sortWithinPartitions("tree", "conv", "turn", "role", "text")
    return rows.select("tree", "conv", "role", "text").mapInPandas(_builder(path or encode.vocabulary_path()), SEQUENCE)


READ = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _reader(path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                for conv, k in zip(r.conv_id, r.leaf, strict=True):
                    formatted = encode.decode(path, np.concatenate([r.input_ids[a:b] for a, b in attention_intervals(r, k)]))
                    learned = []
                    while k >= 0:
                        if r.loss_end[k] > r.loss_start[k]:
                            learned.append(unescape(encode.decode(path, r.input_ids[r.loss_start[k]:r.loss_end[k]])))
                        k = r.parent[k]
                    found, loss = turns_of(formatted), "".join(reversed(learned))
                    digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in found).encode()).hexdigest()
                    id_ = None if conv is None else int(conv)
                    out.append((id_, len(found), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            frame = pd.DataFrame(out, columns=[x.split()[0] for x in READ.split(", ")])
            yield frame.astype({"conv_id": "Int64"})

    return run


def read_back(sequences: DataFrame, path: str | None = None) -> DataFrame:
    """One row per conversation, decoded from the sequences' tokens, intervals and loss spans."""
    return sequences.mapInPandas(_reader(path or encode.vocabulary_path()), READ)


def probe(turns: DataFrame) -> DataFrame:
    """Conversation -7, whose texts look like the template."""
    text = "\\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    return turns.select("conv_id", "turn", "role", "text").unionByName(turns.sparkSession.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))


def format_table(turns: DataFrame) -> DataFrame:
    """Formats all conversations and the probe, and reads them back."""
    return read_back(prefix_trees(probe(turns)))
