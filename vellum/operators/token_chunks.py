"""Chunks of documents whose limit is counted by a tokenizer, in the form in which they are embedded.

A chunk is embedded as its headings and its text, a line each; that is what is counted. Hierarchical chunks
(``items_of``) are cut between their items, then within an item that alone is too long, and neighbours
under the same headings are put together again.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators.chunking import InForce
from vellum.operators.grouped import each_group
from vellum.operators.serialize import markdown_part, marked

CHUNKS = "doc_id bigint, chunk_id bigint, headings array<string>, text string, nodes array<bigint>, n_tokens bigint, with_headings boolean"
#: The level of a heading without one, which is in force nowhere.
NO_LEVEL = -1
#: The pattern of pieces of the tokenizer that drops white space; characters of lines whose counts are kept, of texts encoded at a time, and of a start of a text.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MEMO, SLICE, START = 1 << 24, 1 << 18, 1 << 15
BLANK = re.compile(r"[ \n\t]")


@lru_cache(maxsize=2)
def tokenizer(path: str):  # noqa: ANN201
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are what runs side by side
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def lines_apart(path: str) -> bool:
    """Whether a tokenizer drops white space and no token reaches over it, so that a text has the tokens of its lines."""
    form = json.loads(tokenizer(path).to_str())
    steps = lambda x, many: [] if x is None else [y for part in x[many] for y in steps(part, many)] if x["type"] == "Sequence" else [x]
    plain = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ") for n in steps(form["normalizer"], "normalizers"))
    cuts = steps(form["pre_tokenizer"], "pretokenizers")
    words = bool(cuts) and cuts[0]["type"] == "Split" and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and cuts[0]["pattern"] == {"Regex": WORDS}
    rest = all(c["type"] == "ByteLevel" and not c["use_regex"] and not c["add_prefix_space"] for c in cuts[1:])
    return plain and words and rest and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in form["added_tokens"])


class Counts:
    """How many tokens texts have; lines seen lately are known where a text has the tokens of its lines."""

    def __init__(self, path: str) -> None:
        self.tokenizer, self.apart = tokenizer(path), lines_apart(path)
        self.known: dict[str, int] = {}
        self.size = 0
        self.long: dict[str, list[int]] = {}

    def learn(self, lines: list[str]) -> None:
        """Count many lines at once."""
        if self.size > MEMO:
            self.known, self.size = {}, 0
        new = [x for x in dict.fromkeys(lines) if x not in self.known]
        for first, last in slices([len(x) for x in new]):
            for line, e in zip(new[first:last], self.tokenizer.encode_batch_fast(new[first:last], add_special_tokens=False), strict=True):
                self.keep(line, len(e.ids))

    def keep(self, line: str, n: int) -> None:
        self.known[line] = n
        self.size += len(line) + 100

    def ends(self, text: str, n: int) -> tuple[list[int], bool]:
        """Where the tokens of a text end, and whether these are all: of a start of it that has more than ``n``, as no token reaches over white space."""
        if text in self.long:
            return self.long[text], True
        size = max(START, 8 * n)
        while True:
            stop = next((m.start() for m in BLANK.finditer(text, size)), len(text))
            found = [b for _, b in self.tokenizer.encode(text[:stop], add_special_tokens=False).offsets]
            if stop == len(text) or len(found) > n:
                return found, stop == len(text)
            size *= 2

    def prepare(self, lines: list[str], limit: int) -> None:
        """Count the lines of a document, and keep where the tokens of its long ones end, which are cut afterwards."""
        self.long = {}
        short = []
        for line in lines:
            if 4 * limit < len(line) <= START and line not in self.long:
                self.long[line], _ = self.ends(line, 0)
                self.keep(line, len(self.long[line]))
            else:
                short.append(line)
        self.learn(short)

    def __call__(self, text: str) -> int:
        lines = text.split("\n") if self.apart else [text]
        try:
            return sum(map(self.known.__getitem__, lines))
        except KeyError:
            self.learn(lines)
            return sum(map(self.known.__getitem__, lines))


@lru_cache(maxsize=2)
def counts(path: str) -> Counts:
    return Counts(path)


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Stretches of texts of ``SLICE`` characters together, or of one text."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and total + size > SLICE:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def token_counts(texts: DataFrame, path: str, column: str = "text", name: str = "n_tokens") -> DataFrame:
    """``texts`` with the number of tokens of a column, special ones left out; a null text has none.

    A slice of a batch is encoded at a time, as encoded texts take some hundred times their size.
    """
    schema = T.StructType([*texts.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(column))
            found: list[int] = []
            for first, last in slices(pc.fill_null(pc.utf8_length(values), 0).to_pylist()):
                own = ["" if v is None else v for v in values.slice(first, last - first).to_pylist()]
                found += [len(e.ids) for e in tokenizer(path).encode_batch_fast(own, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, name])

    return texts.mapInArrow(run, schema)


def items_of(walk: DataFrame) -> DataFrame:
    """(doc_id, pos, list_id, node_id, part): the items of hierarchical chunks in order."""
    return _flow(walk).where("head_level is null").drop("head_level")


def _flow(walk: DataFrame) -> DataFrame:
    """(doc_id, pos, list_id, node_id, head_level, part): the items, and the headings, which have a level and their text as part.

    In order, what one outermost list holds is one chunk of several items.
    """
    heading = F.col("label").isin("title", "section_header")
    level = F.when(heading, F.when(F.col("label") == "title", 0).otherwise(F.coalesce("level", F.lit(NO_LEVEL)))).cast("bigint")
    part = F.when(heading, F.col("text")).otherwise(markdown_part(escape=False))
    rows = marked(walk).select("doc_id", "pos", F.get("lists", 0).alias("list_id"), "node_id", level.alias("head_level"), part.alias("part"))
    return rows.where("head_level is not null or part <> ''")


class Chunk:
    __slots__ = ("headings", "nodes", "shown", "text")

    def __init__(self, headings: tuple[str, ...], text: str, nodes: tuple[int, ...], shown: bool = True) -> None:
        self.headings, self.text, self.nodes, self.shown = headings, text, nodes, shown

    def embedded(self) -> str:
        return "\n".join([*(self.headings if self.shown else ()), self.text])


class Chunker:
    """Cuts and joins the chunks of one document up to ``limit`` tokens."""

    def __init__(self, limit: int, count: Counts | Callable[[str], int], spans: Callable[[str], list[tuple[int, int]]], merge: bool) -> None:
        self.limit, self.count, self.spans, self.merge = limit, count, spans, merge
        self.apart = isinstance(count, Counts) and count.apart

    def fits(self, chunk: Chunk) -> bool:
        return self.count(chunk.embedded()) <= self.limit

    def between_items(self, headings: tuple[str, ...], items: list[tuple[int, str]]) -> Iterator[Chunk]:
        """Runs of items, each as long as it fits; an item that does not fit alone stands alone."""
        now: Chunk | None = None
        for node, part in items:
            more = Chunk(headings, part if now is None else f"{now.text}\n{part}", (*(now.nodes if now else ()), node))
            if now is not None and not self.fits(more):
                yield now
                more = Chunk(headings, part, (node,))
            now = more
        if now is not None:
            yield now

    def within(self, chunk: Chunk) -> Iterator[Chunk]:
        """Pieces of a text that is too long: each ends at the last white space that lets it fit, or else at the last token; headings that leave no room are not shown."""
        room = self.limit - (sum(map(self.count, chunk.headings if chunk.shown else ())) if self.apart else self.count(chunk.embedded()) - self.count(chunk.text))
        shown = chunk.shown and room > 0
        piece = lambda text: Chunk(chunk.headings, text, chunk.nodes, shown)
        left = room if shown else self.limit  # tokens that a piece may have
        text = chunk.text.strip()
        ends: list[int] = []
        all_ = False
        while text:
            if self.apart:
                if not all_ and len(ends) <= max(1, left) + 1:
                    ends, all_ = self.count.ends(text, max(1, left) + 1)
                if all_ and len(ends) <= left:
                    break
            elif self.fits(piece(text)):
                break
            else:
                ends = [b for _, b in self.spans(text)]
            n = min(len(ends) - 1, max(1, left))
            kept = 0
            while n > 0:
                at = ends[n - 1]
                space = max(text.rfind(c, 0, at + 1) for c in " \n\t")
                known = bisect_right(ends, space) if self.apart else 0  # tokens before white space, and those after it, stay as they are
                if space > 0 and text[:space].strip() and (known <= left if self.apart else self.fits(piece(text[:space].rstrip()))):
                    stop, kept = space, known
                    break
                if at > 0 and text[:at].strip() and self.fits(piece(text[:at].rstrip())):
                    stop = at
                    break
                n -= 1
            else:
                stop = max(1, ends[0])  # not even one token fits
            done = text[:stop].rstrip()
            if kept and "\n" not in done:
                self.count.keep(done, kept)
            yield piece(done)
            rest = text[stop:].lstrip()
            shift = len(text) - len(rest)
            ends, all_ = ([b - shift for b in ends[kept:]], all_) if kept else ([], False)
            text = rest
        if text:
            if self.apart and "\n" not in text:
                self.count.keep(text, len(ends))
            yield piece(text)

    def peers(self, chunks: Iterator[Chunk]) -> Iterator[Chunk]:
        """Neighbours under the same headings together, as many as fit."""
        now: Chunk | None = None
        for chunk in chunks:
            if now is not None and self.merge and (now.headings, now.shown) == (chunk.headings, chunk.shown):
                more = Chunk(now.headings, f"{now.text}\n{chunk.text}", tuple(dict.fromkeys(now.nodes + chunk.nodes)), now.shown)
                if self.fits(more):
                    now = more
                    continue
            if now is not None:
                yield now
            now = chunk
        if now is not None:
            yield now

    def document(self, groups: list[tuple[tuple[str, ...], list[tuple[int, str]]]]) -> list[Chunk]:
        whole = (c for headings, items in groups for c in self.between_items(headings, items))
        return list(self.peers(p for c in whole for p in ([c] if self.fits(c) else self.within(c))))


def hybrid(walk: DataFrame, limit: int, path: str, *, merge: bool = True) -> DataFrame:
    """``CHUNKS`` rows of walked documents: no chunk's embedded form has over ``limit`` tokens of the tokenizer file at ``path``.

    Texts are whole: the pieces of an item follow each other with no more than the white space at their ends left out. A
    limit under one token's length, or headings that fill it, leave pieces of a token, headings not shown
    (``with_headings`` false). Documents without texts have no chunks.
    """

    def document(part: pd.DataFrame) -> list[tuple]:
        groups: list[tuple] = []
        last = None
        now = InForce()
        for pos, held, node, level, text in zip(part.pos, part.list_id, part.node_id, part.head_level, part.part, strict=True):
            if level == level and level is not None:
                if level != NO_LEVEL:
                    now.add(int(level), None if pd.isna(text) else text)
                continue
            chunk = -1 - pos if pd.isna(held) else held
            if chunk != last:
                groups.append((tuple(now.texts), []))
                last = chunk
            groups[-1][1].append((int(node), text))
        spans = lambda text: tokenizer(path).encode(text, add_special_tokens=False).offsets
        count = counts(path)
        if count.apart:
            count.prepare([line for _, items in groups for _, text in items for line in text.split("\n")], limit)
        chunker = Chunker(limit, count, spans, merge)
        return [(i, list(c.headings), c.text, list(c.nodes), count(c.embedded()), c.shown) for i, c in enumerate(chunker.document(groups))]

    return each_group(_flow(walk), ["doc_id"], ["pos"], document, CHUNKS)


def embedded(headings: Column, text: Column, shown: Column) -> Column:
    """What a chunk is embedded as."""
    return F.when(shown, F.concat_ws("\n", headings, text)).otherwise(text)
