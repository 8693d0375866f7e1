"""Edit-aware token counts.

A text is cut into pre-tokens, which are encoded on their own, so a text's count is the
sum of theirs. Per document a segment tree over runs of pre-tokens holds characters and
tokens. An edit re-encodes only the pre-tokens it touches plus boundary context, and
updates the sums on the way to the root:

* on the left, cutting starts again at the last boundary that lies at least two
  characters before the edit: the pattern looks at most two characters beyond a match;
* on the right, cutting goes on until a new boundary falls on an old one behind the
  edit; from there on the old pre-tokens stand, as the pattern never looks back.

Defined cases: null text counts as empty (no tokens); null or empty edits leave the
count; places outside the text are clipped to it, null places count as 0, null
replacements as empty; edits apply in order, each to the text that the earlier ones
left; repeated rows are counted each; null ids are kept; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, read_table
from .tokens import Encoder, default_path, encoder

RUN = 32                 # pre-tokens of a leaf
LOOK_AHEAD = 2           # characters that the pattern reads beyond a match
CACHE_WORDS = 300_000    # distinct pre-tokens kept per worker

EDITS = "array<struct<start:int,length:int,text:string>>"


class Counter:
    """Token counts of pre-tokens, with a bounded cache."""

    def __init__(self, codec: Encoder):
        self.codec, self.known = codec, {}

    def counts(self, pre_tokens: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        try:
            return [known[p] for p in pre_tokens]
        except KeyError:
            for p in set(pre_tokens):
                if p not in known:
                    known[p] = self.codec.count(p)
            return [known[p] for p in pre_tokens]


class CountTree:
    """Segment tree over the pre-tokens of one text."""

    def __init__(self, text: str, counter: Counter):
        self.counter = counter
        pieces = counter.codec.pre_tokens(text)
        counts = counter.counts(pieces)
        self.n_pre_tokens = len(pieces)
        self.encoded = 0           # pre-tokens re-encoded by edits
        self.leaves = [pieces[at:at + RUN] for at in range(0, len(pieces), RUN)] or [[]]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for k, leaf in enumerate(self.leaves):
            self.chars[self.width + k] = sum(map(len, leaf))
            self.tokens[self.width + k] = sum(counts[k * RUN:(k + 1) * RUN])
        for node in range(self.width - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(p for leaf in self.leaves for p in leaf)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one for the end), and
        where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.chars[node]:
                # a right subtree without leaves or text holds nothing to find
                if self.chars[node + 1] == 0:
                    continue
                begin += self.chars[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), begin

    def _set(self, first: int, last: int, pieces: list[str], counts: list[int]) -> None:
        """Leaves ``first``..``last`` hold ``pieces`` from now on, spread evenly."""
        share = -(-len(pieces) // (last - first + 1)) or 1
        for k in range(first, last + 1):
            at = (k - first) * share
            self.leaves[k] = pieces[at:at + share]
            self.chars[self.width + k] = sum(map(len, self.leaves[k]))
            self.tokens[self.width + k] = sum(counts[at:at + share])
        nodes = {(self.width + k) // 2 for k in range(first, last + 1)}
        while nodes and 0 not in nodes:
            for node in nodes:
                self._sum(node)
            nodes = {node // 2 for node in nodes}

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start``."""
        start = min(max(start, 0), self.n_chars)
        end = min(max(start + length, start), self.n_chars)
        first, begin = self._find(max(0, start - LOOK_AHEAD))
        head, at = [], begin
        for piece in self.leaves[first]:
            if at + len(piece) > start - LOOK_AHEAD:
                break
            head.append(piece)
            at += len(piece)
        restart = at                                  # cutting starts again here
        last, last_begin = self._find(end)
        old_end = last_begin + sum(map(len, self.leaves[last]))
        old = [p for k in range(first, last + 1) for p in self.leaves[k]][len(head):]
        grow = 1
        while True:
            text = "".join(old)
            final = old_end >= self.n_chars
            new_text = text[:start - restart] + replacement + text[end - restart:]
            cut = self.counter.codec.pre_tokens(new_text)
            old_bounds, place = set(), restart
            for p in old:
                old_bounds.add(place)
                place += len(p)
            shift = len(replacement) - (end - start)
            new, at, joined = [], 0, None
            for p in cut:
                where = restart + at - shift          # the same place in the old text
                if at >= start - restart + len(replacement) and where in old_bounds \
                        and (final or at + LOOK_AHEAD <= len(new_text)):
                    joined = where
                    break
                new.append(p)
                at += len(p)
            if joined is not None or final:
                break
            for _ in range(grow):
                if last + 1 < len(self.leaves):
                    last += 1
                    old += self.leaves[last]
                    old_end += sum(map(len, self.leaves[last]))
            grow *= 2
        tail, place = [], restart
        for p in old:
            if joined is not None and place >= joined:
                tail.append(p)
            place += len(p)
        # only the new pre-tokens are encoded; head and tail have known counts
        self.encoded += len(new)
        pieces = head + new + tail
        self._set(first, last, pieces, self.counter.counts(pieces))


def edited_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits",
                  path: str | None = None) -> DataFrame:
    """Rows (doc_id, n_pre_tokens, n_tokens, n_tokens_edited, n_encoded), one per input row."""
    path = path or default_path()
    schema = "doc_id long, n_pre_tokens long, n_tokens long, n_tokens_edited long, n_encoded long"
    names = [f.split()[0] for f in schema.split(", ")]

    def make():
        counter = Counter(encoder(path))

        def f(batch, texts):
            rows = []
            for doc_id, text, edits in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
                tree = CountTree(text.decode(), counter)
                before = tree.n_tokens
                for e in edits or []:
                    if e is not None:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["text"] or "")
                rows.append((doc_id, tree.n_pre_tokens, before, tree.n_tokens, tree.encoded))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
        return f
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(edits_col).cast(EDITS).alias("edits"))
    return map_texts(rows, "text", make, schema)


def _edit(start: Column, length: Column, text: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), length.cast("int").alias("length"), text.alias("text"))


def pipeline_edits(text: Column, source: Column) -> Column:
    """The edits of the registered query: the first long number is masked, the character in
    the middle is deleted, and a line with the source goes on top."""
    number = F.lit(r"[0-9]{4,}")
    found = F.regexp_substr(text, number)
    mask = F.when(found.isNotNull(), _edit(F.regexp_instr(text, number) - 1, F.char_length(found), F.lit("0")))
    middle = _edit(F.floor(F.char_length(text) / 2), F.lit(1), F.lit(""))
    top = _edit(F.lit(0), F.lit(0), F.concat(F.coalesce(source, F.lit("")), F.lit("\n")))
    return F.array_compact(F.array(mask, middle, top))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return edited_counts(docs.withColumn("edits", pipeline_edits(F.col("text"), F.col("source"))))
