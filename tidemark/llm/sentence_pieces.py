"""SentencePiece merge-type (BPE) encoding without a merge queue, and decoding.

The library starts from characters and joins the neighbouring pair whose joint piece has the highest score, the
leftmost of equals, until none is left. The outcome is the one division in which every token is what merging makes of
its own text, and every two neighbours are what merging makes of their joint text. So a word is read from the left:
at each position the longest piece (found for all positions in one pass of an Aho-Corasick automaton) is tried, then
the shorter pieces that are its prefixes; a piece is taken if it agrees with the token before it, which is decided by
merging the two texts again and remembered. If no piece agrees, the position is marked in a bitfield, so that it is
never reached again, and the token before it is given up for a shorter one.

A text is cut before every run of spaces where no piece of the model spans such a place, because then no merge does.
Each distinct word of a batch is encoded once. Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices

SPACE = "▁"
#: Pairs and words a task remembers; beyond that it starts afresh.
REMEMBERED = 1 << 18
REMEMBERED_WORDS = 1 << 20
#: Bytes of text that are encoded at a time.
ENCODED_BYTES = 2 << 20
#: How the library writes the unknown piece.
UNKNOWN_SURFACE = " ⁇ "
RUN = re.compile(rb" +[^ ]*")


class Characters(dict):
    """Tokens of single characters; one that is no piece has a number below zero."""

    def __missing__(self, c: str) -> int:
        return -1 - ord(c)


class PieceModel:
    """Pieces and scores of a model file, read with the library; encoding and decoding are done here."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        if any(model.is_unused(i) for i in range(count)):
            raise ValueError("models with unused pieces are not supported")
        probe = " a  ﬁ\t"
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("only models with a leading space and no other normalization are supported")
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(count)]
        self.unknown = model.unk_id()
        self.id_of = {names[i]: i for i in range(count) if not special[i]}
        self.score_of = {names[i]: model.get_score(i) for i in range(count) if not special[i]}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a piece spans the begin of a word")
        self.names = names
        self.byte_of = {i: int(names[i][3:5], 16) for i in range(count) if model.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.byte_of.items()}
        self.characters = Characters(self.id_of)
        self.lengths = [len(x) for x in names]
        self.pairs: dict[tuple[int | None, int], bool] = {}
        self.first: dict[tuple[int | None, int], int | None] = {}
        self.words: dict[bytes, tuple[int, ...]] = {}
        surface = [b"" if model.is_control(i) else names[i].replace(SPACE, " ").encode() for i in range(count)]
        surface[self.unknown] = UNKNOWN_SURFACE.encode()
        for i, b in self.byte_of.items():
            surface[i] = bytes([b])
        self.surface = pa.array(surface, pa.large_binary())
        self.sizes = np.array([len(x) for x in surface], np.int64)
        self.is_byte = np.array([model.is_byte(i) for i in range(count)])
        self.is_control = np.array([model.is_control(i) for i in range(count)])
        self.begins_with_space = np.array([not special[i] and names[i].startswith(SPACE) for i in range(count)])

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """All pieces of two or more characters; only encoding needs it."""
        made = ahocorasick.Automaton()
        for name, i in self.id_of.items():
            if len(name) > 1:
                made.add_word(name, (len(name), i))
        made.make_automaton()
        return made

    @cached_property
    def shorter(self) -> dict[int, int | None]:
        """Of each piece the next shorter token at the same place."""
        return {i: self._longest_prefix(name) for name, i in self.id_of.items()}

    def _longest_prefix(self, name: str) -> int | None:
        """A piece, or the bare first character."""
        for k in range(len(name) - 1, 0, -1):
            if name[:k] in self.id_of:
                return self.id_of[name[:k]]
        return self.characters[name[0]] if len(name) > 1 else None

    def text_of(self, token: int) -> str:
        return self.names[token] if token >= 0 else chr(-1 - token)

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text: best score first, leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score_of.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def agree(self, left: int | None, right: int) -> bool:
        """Whether merging the joint text of two tokens gives just these two (or the one, at a word's begin)."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            own = [self.text_of(right)] if left is None else [self.text_of(left), self.text_of(right)]
            known = self.pairs[left, right] = self.merge("".join(own)) == own
        return known

    def first_fitting(self, left: int | None, token: int) -> int | None:
        """Of a token and the shorter ones at its place the longest that agrees with the token before; None without one."""
        if len(self.first) >= REMEMBERED:
            self.first.clear()
        found: int | None = token
        while found is not None and not self.agree(left, found):
            found = self.shorter[found] if found >= 0 else None
        self.first[left, token] = found
        return found

    def longest(self, text: str) -> list[int]:
        """For every position the longest token that begins there."""
        characters = self.characters
        found = [characters[c] for c in text]
        for last, (size, token) in self.automaton.iter(text):
            found[last + 1 - size] = token  # ends come in rising order, so the longest is written last
        return found

    def tokens(self, text: str) -> list[int]:
        """Tokens of a text in pieces' characters (spaces as the space sign)."""
        whole = self.id_of.get(text)
        if whole is not None and self.agree(None, whole):
            return [whole]
        size, sizes, shorter, pairs = len(text), self.lengths, self.shorter, self.pairs
        longest = self.longest(text)
        out: list[int] = []
        at, last, token = 0, None, None
        first = self.first
        while at < size:
            whole = longest[at]
            token = first.get((last, whole))
            if token is None:
                token = self.first_fitting(last, whole)
                if token is None:
                    break
            out.append(token)
            at += sizes[token] if token >= 0 else 1
            last = token
        # where a token had to be given up: from here on with the places that lead nowhere
        failed = bytearray((size >> 3) + 1 if at < size else 0)  # one bit per position
        any_failed = False
        while at < size:
            while token is not None:
                fits = pairs.get((last, token))
                if fits is None:
                    fits = self.agree(last, token)
                if fits:
                    end = at + (sizes[token] if token >= 0 else 1)
                    if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                        break
                token = shorter[token] if token >= 0 else None
            if token is not None:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < size else None
            else:
                if not out:
                    raise ValueError("the pieces of this model have no division of the text that agrees")
                failed[at >> 3] |= 1 << (at & 7)
                any_failed = True
                token = out.pop()
                last = out[-1] if out else None
                at -= sizes[token] if token >= 0 else 1
        return out

    def numbers(self, tokens: list[int]) -> list[int]:
        """Ids of tokens: a character outside the vocabulary as its bytes; without byte pieces a run of them is unknown."""
        if not tokens or min(tokens) >= 0:
            return tokens
        out: list[int] = []
        for k, t in enumerate(tokens):
            if t >= 0:
                out.append(t)
            elif self.id_of_byte:
                out += [self.id_of_byte[b] for b in chr(-1 - t).encode()]
            elif not k or tokens[k - 1] >= 0:
                out.append(self.unknown)
        return out

    def word(self, word: bytes) -> tuple[int, ...]:
        """Ids of a word that follows a space (the space is not part of ``word``; further spaces before it are)."""
        ids = self.words.get(word)
        if ids is None:
            # tuples of numbers, unlike lists, are not looked at by the garbage collection
            ids = tuple(self.numbers(self.tokens(SPACE + word.decode("utf-8", "replace").replace(" ", SPACE))))
            if len(word) <= 64:
                if len(self.words) >= REMEMBERED_WORDS:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def encode(self, texts: list[bytes]) -> pa.LargeListArray:
        """Ids of each text; an empty text has none."""
        lists = [split(x) for x in texts]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=bounds[1:])
        coded, distinct = codes(list(chain.from_iterable(lists)))
        made = [self.word(w) for w in distinct]
        edges = np.zeros(len(made) + 1, np.int64)
        np.cumsum([len(x) for x in made], out=edges[1:])
        values = pa.array(np.fromiter(chain.from_iterable(made), np.int32, edges[-1]))
        flat = pa.LargeListArray.from_arrays(pa.array(edges), values).take(pa.array(coded)).flatten()
        ends = np.zeros(len(coded) + 1, np.int64)
        np.cumsum(np.diff(edges)[coded], out=ends[1:])
        return pa.LargeListArray.from_arrays(pa.array(ends[bounds]), flat)

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> list[str]:
        """Texts of consecutive lists of ids. Bytes that are no UTF-8 become replacement characters, one each.

        Control pieces are silent; one space at the begin of the first other piece is dropped.
        """
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.sizes[ids], out=ends[1:])
        joined = self.surface.take(pa.array(ids)).buffers()[2] if ends[-1] else None
        joined = joined.to_pybytes() if joined else b""
        loud, bytewise = np.flatnonzero(~self.is_control[ids]), np.concatenate([[0], np.cumsum(self.is_byte[ids])])
        heads = np.searchsorted(loud, edges[:-1])
        out = []
        for a, b, h in zip(edges[:-1].tolist(), edges[1:].tolist(), heads.tolist(), strict=True):
            first = int(loud[h]) if h < len(loud) and loud[h] < b else -1
            skip = int(first >= 0 and bool(self.begins_with_space[ids[first]]))
            try:
                if bytewise[b] > bytewise[a] and self.is_control[ids[a:b]].any():
                    raise UnicodeError  # a silent piece parts the bytes of a character
                out.append(joined[ends[a] + skip : ends[b]].decode())
            except UnicodeError:
                out.append("".join(self._mended(ids[a:b].tolist()))[skip:])
        return out

    def _mended(self, ids: list[int]) -> Iterator[str]:
        run = bytearray()
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run.append(self.byte_of[i])
                continue
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        yield bytes(run[at : at + size]).decode()
                        break
                    except UnicodeDecodeError:
                        size = 0
                else:
                    yield "�"
                at += size or 1
            run.clear()
            if i is not None:
                yield self.surface[i].as_py().decode()


def split(text: bytes) -> list[bytes]:
    """Words of a text with the space put before it; further spaces of a run stay with the word that follows."""
    if not text:
        return []
    text = text.replace(SPACE.encode(), b" ")
    if b"  " in text or text[:1] == b" ":
        return [w[1:] for w in RUN.findall(b" " + text)]
    return text.split(b" ")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, ids): the ids of every whole text, exactly as the library's without begin and end pieces.

    With ``decoded``, a third column has the text that the ids decode to. ``model`` is the path of a model file that
    every executor can read. A null text counts as empty and has no ids. Repeated rows and null ids are rows of their
    own; other columns are not looked at, whatever their names. No rows give no rows. One pass, no shuffle: a task
    holds a few megabytes of text at a time, or one longer text.
    """
    prepare(docs.sparkSession)
    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for part, texts in slices(batches, limit=ENCODED_BYTES):
            ids = pieces.encode(texts).cast(pa.list_(pa.int32()))
            columns = {"id": part.column("id"), "ids": ids}
            if decoded:
                columns["decoded"] = pa.array(pieces.decode(ids.values.to_numpy(), ids.offsets.to_numpy().astype(np.int64)), pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"id {kind}, ids array<int>" + ", decoded string" * decoded
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the texts of the ids, as the library's decode gives them.

    Null lists and null ids in a list count as absent. ``encoded`` must not have a column named ``decoded``.
    """
    prepare(encoded.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_model(model)
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(ids_col)
            present = [[] if x is None else x for x in lists.to_pylist()] if lists.null_count or lists.flatten().null_count else None
            if present is None:
                edges = lists.offsets.to_numpy().astype(np.int64)
                ids, edges = lists.flatten().to_numpy(), edges - edges[0]
            else:
                present = [[i for i in x if i is not None] for x in present]
                edges = np.concatenate([[0], np.cumsum([len(x) for x in present])]).astype(np.int64)
                ids = np.array([i for x in present for i in x], np.int32)
            texts = pieces.decode(ids, edges)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema + ", decoded string")
