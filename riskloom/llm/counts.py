"""Token counts that follow edits.

A document's pre-tokens are the leaves of a segment tree whose nodes sum characters and
tokens. An edit re-tokenises from the leaf before it (a match looks one character ahead)
until a new boundary falls on an old one behind the edit: a match depends only on the text
from its start on, so all leaves from there on stay. The replaced leaves are updated in
place and only the sums above them change.

The leaves can be kept between runs: characters and tokens of every pre-token, with a
checksum of the text they belong to. The tree of the next run is built from them, so that
text which no edit touches is never tokenised again.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.bpe import encoding
from riskloom.llm.common import BoundedMemo, process_cache, quoted, text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What is kept of a text: checksum of its UTF-8 bytes, and two numbers a pre-token.
LEAVES = "struct<text_crc32:bigint,chars:array<int>,tokens:array<int>>"


def token_counter(path: str, pattern: str) -> tuple[regex.Pattern, BoundedMemo]:
    """The pattern, and how many tokens a pre-token has; remembered per worker."""

    def make() -> tuple[regex.Pattern, BoundedMemo]:
        core = encoding(path, pattern)[0]._core_bpe
        return regex.compile(pattern), BoundedMemo(lambda piece: len(core.encode_single_piece(piece.encode())), 500_000)

    return process_cache(("counts", path, pattern), make)


class TokenTree:
    """Pre-tokens of one text with sums of characters and tokens."""

    def __init__(self, text: str, pattern: regex.Pattern, tokens: BoundedMemo, kept: dict | None = None):
        self.pattern, self.tokens = pattern, tokens
        self.encoded = 0
        self.parts: dict[int, list[str]] = {}  # pre-tokens of the leaves that hold several
        self.reused = kept is not None and _fits(kept, text)
        if self.reused:
            ends = np.cumsum(np.array(kept["chars"], np.int64)).tolist()
            self.leaves = [text[a:b] for a, b in zip([0, *ends], ends)]
            counts = kept["tokens"]
        else:
            self.leaves = pattern.findall(text)
            counts = [tokens[x] for x in self.leaves]
        self.size = 1 << max(0, len(self.leaves) - 1).bit_length()
        chars = np.zeros(self.size, np.int64)
        sums = np.zeros(self.size, np.int64)
        chars[: len(self.leaves)] = [len(x) for x in self.leaves]
        sums[: len(self.leaves)] = counts
        self.chars, self.sums = _tree(chars), _tree(sums)

    def kept(self) -> dict:
        """The leaves as ``LEAVES`` has them, one for each pre-token."""
        chars, tokens = [], []
        for i, x in enumerate(self.leaves):
            for part in self.parts.get(i, [x] if x else []):
                chars.append(len(part))
                tokens.append(self.tokens[part] if i in self.parts else self.sums[self.size + i])
        return {"text_crc32": zlib.crc32(self.text().encode()), "chars": chars, "tokens": tokens}

    def __len__(self) -> int:
        return self.sums[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _leaf(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) that holds a place; the last one with text for the end."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.size, start

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        node = leaf + self.size
        more, most = len(text) - self.chars[node], tokens - self.sums[node]
        while node:
            self.chars[node] += more
            self.sums[node] += most
            node //= 2

    def edit(self, start: int, length: int, insert: str) -> None:
        """Replace ``length`` characters from ``start`` on (cut at the ends of the text)."""
        total = self.chars[1]
        start = min(max(0, start), total)
        end = min(total, start + max(0, length))
        if not self.leaves:
            reused = self.reused
            self.__init__(insert, self.pattern, self.tokens)
            self.encoded, self.reused = len(self.leaves), reused
            return
        # one leaf of context: the leaf before the one that the character before the edit is in
        first, begin = self._leaf(max(0, start - 1))
        if begin:
            first, begin = self._leaf(begin - 1)
        ahead = 4
        while True:
            old, at, last = [], begin, first
            beyond = 0
            while last < len(self.leaves) and (at < end or beyond < ahead):
                old.append(self.leaves[last])
                beyond += at >= end and bool(self.leaves[last])
                at += len(self.leaves[last])
                last += 1
            joined = "".join(old)
            text = joined[: start - begin] + insert + joined[end - begin :]
            found = self.pattern.findall(text)
            grown = len(text) - len(joined)
            if last >= len(self.leaves):
                keep, stop = len(found), last
                break
            # old boundaries behind the edit, in the new text
            places, at = {}, begin
            for k, x in enumerate(old):
                if k and at >= end and x:  # the first leaf is needed to hold what is new
                    places[at - begin + grown] = first + k
                at += len(x)
            keep, at = None, 0
            for k, x in enumerate(found[:-1]):  # the last two may look beyond what was read
                if k < len(found) - 2 and at in places and at >= start - begin + len(insert):
                    keep, stop = k, places[at]
                    break
                at += len(x)
            if keep is not None:
                break
            ahead *= 2
        fresh = found[:keep]
        self.encoded += keep
        # the new pre-tokens take the old leaves; what is over shares the last one
        slots = range(first, stop)
        for k, leaf in enumerate(slots):
            mine = fresh[k:] if k == len(slots) - 1 else fresh[k : k + 1]
            self._set(leaf, "".join(mine), sum(self.tokens[x] for x in mine))
            if len(mine) > 1:
                self.parts[leaf] = mine
            else:
                self.parts.pop(leaf, None)


def _fits(kept: dict, text: str) -> bool:
    """The kept leaves are whole and belong to this text."""
    chars, tokens = kept["chars"], kept["tokens"]
    if chars is None or tokens is None or len(chars) != len(tokens) or None in chars or None in tokens or min(chars, default=1) < 1:
        return False
    return sum(chars) == len(text) and kept["text_crc32"] == zlib.crc32(text.encode())


def _tree(leaves: np.ndarray) -> list[int]:
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(levels[-1][::2] + levels[-1][1::2])
    return [0, *np.concatenate(levels[::-1]).tolist()]


def count_tokens(
    docs: DataFrame, path: str, pattern: str, edits: str | None = None, key: str = "doc_id", text: str = "text",
    leaves: str | None = None, keep_leaves: bool = False,
) -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_edited, n_encoded, reused, edited) of every row.

    ``edits`` names a column array<struct<start, length, insert>>, in characters of the text
    as it is when the edit's turn comes. ``n_encoded`` counts the pre-tokens that edits had
    encoded anew; ``edited`` is the text afterwards. Null texts and inserts count as empty,
    null numbers as 0, a null list as none.

    With ``keep_leaves`` a last column ``leaves`` (``LEAVES``) describes the edited text. Given
    back as the column ``leaves`` of a later run over that text, it spares the text's own
    tokenisation (``reused``). Leaves that are null, broken, or of another text are passed over.
    """
    kind = docs.schema[key].dataType.simpleString()
    listed = F.col(quoted(edits)) if edits else F.lit(None)
    known = F.col(quoted(leaves)) if leaves else F.lit(None)
    rows = docs.select(
        F.col(quoted(key)).alias("id"), text_of(text).alias("text"),
        listed.cast("array<struct<start:bigint,length:bigint,insert:string>>").alias("edits"), known.cast(LEAVES).alias("leaves"),
    )
    schema = f"id {kind}, n_tokens bigint, n_edits bigint, n_tokens_edited bigint, n_encoded bigint, reused boolean, edited string"
    return rows.mapInArrow(_run(path, pattern, keep_leaves), schema + (f", leaves {LEAVES}" if keep_leaves else "")).withColumnRenamed("id", key)


def _run(path: str, pattern: str, keep_leaves: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, tokens = token_counter(path, pattern)
        numbers = pa.list_(pa.int32())
        kinds = [*[pa.int64()] * 4, pa.bool_(), pa.string()]
        names = ["n_tokens", "n_edits", "n_tokens_edited", "n_encoded", "reused", "edited"]
        if keep_leaves:
            kinds.append(pa.struct([("text_crc32", pa.int64()), ("chars", numbers), ("tokens", numbers)]))
            names.append("leaves")
        for batch in batches:
            out = []
            for t, todo, known in zip(*(batch.column(c).to_pylist() for c in ("text", "edits", "leaves"))):
                tree = TokenTree(t, split, tokens, known)
                n = len(tree)
                for e in todo or ():
                    e = e or {}
                    tree.edit(e.get("start") or 0, e.get("length") or 0, e.get("insert") or "")
                row = (n, len(todo or ()), len(tree), tree.encoded, tree.reused, tree.text() if todo else t)
                out.append((*row, tree.kept()) if keep_leaves else row)
            columns = list(zip(*out)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=["id", *names])

    return run


def masking_edits(docs: DataFrame, mask: str, insert: str, text: str = "text", to: str = "edits") -> DataFrame:
    """Adds the edits that replace every match of ``mask``, last match first."""
    kept = [c for c in docs.columns if c != to]
    row = docs.select(*map(quoted, kept)).schema.simpleString()
    schema = f"row {row}, edits array<struct<start:bigint,length:bigint,insert:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(mask)
        for batch in batches:
            out = [
                [{"start": m.start(), "length": m.end() - m.start(), "insert": insert} for m in find.finditer(t)][::-1]
                for t in batch.column("text").to_pylist()
            ]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("insert", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, kind)], names=["row", "edits"])

    rows = docs.select(F.struct(*map(quoted, kept)).alias("row"), text_of(text).alias("text")).mapInArrow(run, schema)
    return rows.select(*[F.col(f"row.{quoted(c)}").alias(c) for c in kept], F.col("edits").alias(to))
