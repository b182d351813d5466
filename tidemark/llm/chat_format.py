"""Chat formatting as prefix trees: conversations that begin alike share their first turns' tokens.

Every turn is written between markers, with control strings inside texts escaped. Conversations are sorted by the
chain of digests of their turns, which puts a prefix tree's leaves in depth-first order; equal conversations are one
leaf. Walking along them, a turn's tokens are written where it differs from the conversation before, so a shared turn
is written once. The walk is cut into packs of bounded size; a pack that begins within a tree writes the turns above
again, since sequences cannot see each other. In a pack every token has the position it has in its conversation, and
every node the intervals of tokens it may look at: its ancestors', merged where they touch, and its own.

Sorting is by the whole chain, so conversations with one first turn, however many, fall into many ranges.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

PACK_TOKENS = 8192
#: Opening and closing marker of each role; other roles name themselves.
MARKERS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("[ANS] ", " </s>")}
OTHER = ("[TURN ", "] ", " [/TURN]")
CONTROL = r"/?(?:INST|SYS|ANS)\]|TURN |/TURN\]|/?s>"
PLAIN_CONTROL = re.compile(rf"([\[<])(\\*)({CONTROL})")
ESCAPED_CONTROL = re.compile(rf"([\[<])\\(\\*)({CONTROL})")
TURN = re.compile(r"\[(?:(INST)|(SYS)|(ANS)|TURN ([^\]]*))\] (.*?) (?:(?(1)\[/INST\])(?(2)\[/SYS\])(?(3)</s>)(?(4)\[/TURN\]))", re.S)


def escape(text: str) -> str:
    """Put a backslash into every control string, and one more into every one that has some."""
    return PLAIN_CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return ESCAPED_CONTROL.sub(r"\1\2\3", text)


def markers(role: str) -> tuple[str, str]:
    return MARKERS.get(role) or (f"{OTHER[0]}{quote(role, safe='')}{OTHER[1]}", OTHER[2])


def format_turn(role: str, text: str) -> str:
    opening, closing = markers(role)
    return opening + escape(text) + closing


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out = []
    for m in TURN.finditer(formatted):
        role = "user" if m[1] else "system" if m[2] else "assistant" if m[3] else unquote(m[4])
        out.append((role, unescape(m[5])))
    return out


class Codec:
    """Tokens of turns by a byte-level rank file; each opening and closing marker is one token of its own.

    The openings of other roles are written as ordinary tokens, as there may be any number of roles.
    """

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = {i: b for b, i in ranks.items()}
        first = max(ranks.values()) + 2  # the number after the ranks is the vocabulary's end of text
        strings = [x for pair in MARKERS.values() for x in pair] + [OTHER[2]]
        self.marker = {s: first + k for k, s in enumerate(strings)}
        self.bytes_of |= {i: s.encode() for s, i in self.marker.items()}

    def ids(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Tokens of a turn, and where among them the text stands."""
        opening, closing = markers(role)
        head = [self.marker[opening]] if opening in self.marker else self.ids(opening)
        body = self.ids(escape(text))
        return [*head, *body, self.marker[closing]], len(head), len(head) + len(body)

    def text(self, ids: list[int]) -> str:
        return b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def chains(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, leaf, chain, roles, texts): one row per conversation, its turns in order.

    ``chain`` is the turns' chained digests, so it sorts like a path; ``leaf`` is a digest of the whole conversation.
    """
    prepare(conversations.sparkSession)
    kind = conversations.schema[conv_col].dataType.simpleString()
    words = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]
    rows = conversations.select(F.col(conv_col).alias("conv"), F.struct(F.col(turn_col).alias("turn"), *words).alias("t"))
    rows = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("t")).select("conv", F.col("t.role").alias("roles"), F.col("t.text").alias("texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, paths = [], []
            for roles, texts in zip(batch.column("roles").to_pylist(), batch.column("texts").to_pylist(), strict=True):
                digest, path = b"", []
                for r, t in zip(roles, texts, strict=True):
                    digest = hashlib.md5(digest + str(len(r)).encode() + b" " + r.encode() + t.encode()).digest()
                    path.append(digest[:8].hex())
                leaves.append(digest.hex())
                paths.append("".join(path))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(leaves, pa.string()), pa.array(paths, pa.string()), batch.column("roles"), batch.column("texts")], ["conv", "leaf", "chain", "roles", "texts"])

    return rows.mapInArrow(run, f"conv {kind}, leaf string, chain string, roles array<string>, texts array<string>")


class Pack:
    """One sequence under way: tokens, their positions and loss mask, nodes and leaves."""

    def __init__(self) -> None:
        self.ids, self.positions, self.loss = [], [], []
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.path: list[tuple[tuple[str, str], int]] = []  # the last conversation's turns and their nodes

    def shared(self, turns: list[tuple[str, str]]) -> int:
        k = 0
        while k < min(len(turns), len(self.path)) and self.path[k][0] == turns[k]:
            k += 1
        return k

    def add(self, leaf: str, turns: list[tuple[str, str]], made: list[tuple[list[int], int, int]]) -> None:
        """Append a conversation; ``made`` has the tokens of the turns that are not shared."""
        keep = len(turns) - len(made)
        del self.path[keep:]
        for turn, (ids, a, b) in zip(turns[keep:], made, strict=True):
            parent = self.path[-1][1] if self.path else -1
            begin, position, spans = len(self.ids), 0, []
            if parent >= 0:
                above = self.nodes[parent]
                position = above["position"] + above["end"] - above["start"]
                spans = [dict(x) for x in above["sees"]]
            if spans and spans[-1]["end"] == begin:
                spans[-1]["end"] = begin + len(ids)
            else:
                spans.append({"start": begin, "end": begin + len(ids)})
            self.ids += ids
            self.positions += range(position, position + len(ids))
            self.loss += [turn[0] == "assistant" and a <= k < b for k in range(len(ids))]
            self.nodes.append({"parent": parent, "start": begin, "end": begin + len(ids), "position": position, "sees": spans})
            self.path.append((turn, len(self.nodes) - 1))
        self.leaves.append({"leaf": leaf, "node": self.path[-1][1]})

    def row(self) -> dict:
        return {"token_ids": self.ids, "position_ids": self.positions, "loss_mask": self.loss, "nodes": self.nodes, "leaves": self.leaves}


SPAN = "struct<start:int,end:int>"
PACK_SCHEMA = f"token_ids array<int>, position_ids array<int>, loss_mask array<boolean>, nodes array<struct<parent:int,start:int,end:int,position:int,sees:array<{SPAN}>>>, leaves array<struct<leaf:string,node:int>>"


def pack_trees(chained: DataFrame, vocabulary: str, pattern: str, tokens: int = PACK_TOKENS) -> DataFrame:
    """Packs of conversations: token ids, position ids, loss mask (assistant texts), nodes with parent, extent, position
    and the token intervals they see (the last is their own, causal), and leaves by digest.

    A pack has at most ``tokens`` tokens unless a single conversation has more. Equal conversations are one leaf.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark = chained.sparkSession
    arrow = to_arrow_schema(_parse_datatype_string(PACK_SCHEMA))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, pack, done = codec(vocabulary, pattern), Pack(), []
        for batch in batches:
            for r in batch.to_pylist():
                turns = list(zip(r["roles"], r["texts"], strict=True))
                made = [code.turn(*t) for t in turns[pack.shared(turns) :]]
                if pack.leaves and len(pack.ids) + sum(len(m[0]) for m in made) > tokens:
                    done.append(pack.row())
                    pack, made = Pack(), [code.turn(*t) for t in turns]
                pack.add(r["leaf"], turns, made)
                if len(done) >= 64:
                    yield pa.RecordBatch.from_pylist(done, arrow)
                    done = []
        if pack.leaves:
            done.append(pack.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, arrow)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves = chained.select("leaf", "chain", "roles", "texts").dropDuplicates(["leaf"])
    return leaves.repartitionByRange(parts, "chain").sortWithinPartitions("chain").mapInArrow(run, PACK_SCHEMA)


def read_back(packs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(leaf, formatted, roles, texts, loss_text): every leaf from the tokens its node sees in its pack."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(vocabulary, pattern)
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(n)[row] for n in ("token_ids", "loss_mask", "nodes", "leaves")}
                ids, loss = np.array(r["token_ids"].values), np.array(r["loss_mask"].values.cast(pa.int8()))
                nodes, out = r["nodes"].as_py(), []
                for leaf in r["leaves"].as_py():
                    at = np.concatenate([np.arange(s["start"], s["end"]) for s in nodes[leaf["node"]]["sees"]])
                    own, mask = ids[at], loss[at]
                    turns = parse(code.text(own.tolist()))
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]])))
                    said = [unescape(code.text(own[a:b].tolist())) for a, b in edges.reshape(-1, 2).tolist()]
                    out.append((leaf["leaf"], code.text(own.tolist()), [x for x, _ in turns], [x for _, x in turns], "".join(said)))
                columns = list(zip(*out, strict=True))
                kinds = (pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["leaf", "formatted", "roles", "texts", "loss_text"])

    return packs.mapInArrow(run, "leaf string, formatted string, roles array<string>, texts array<string>, loss_text string")


def format_conversations(conversations: DataFrame, vocabulary: str, pattern: str, tokens: int = PACK_TOKENS, **columns) -> tuple[DataFrame, DataFrame]:
    """Packs of all conversations, and (conv, leaf): where each conversation is found.

    Rows are turns; null roles and texts count as empty. Turns with one number are ordered by role, then text, and
    repeated rows are turns of their own. A null conversation id is a conversation. A conversation longer than a pack
    is a pack. Without rows there are no packs. Other columns are not looked at.
    """
    chained = chains(conversations, **columns)
    return pack_trees(chained, vocabulary, pattern, tokens), chained.select("conv", "leaf")
