"""Token counts that follow edits without encoding whole documents again."""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import small_batches, whole_text, write_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A leaf is cut at the first safe place after so many code points.
LEAF_POINTS = 512
#: Between a letter and a blank before a letter the pattern always cuts, whatever else stands around.
_SAFE = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")

_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(path: str = VOCABULARY) -> tiktoken.Encoding:
    """The encoding of a rank file, read once per process."""
    if path not in _encoders:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


@dataclass
class CountTree:
    """A segment tree over a document's leaves: runs of pre-tokens with their token counts.

    ``sums`` is the tree in heap order: node 1 is the root, node i has the
    children 2i and 2i + 1, and the second half holds the leaves.
    """

    lengths: list[int]
    sums: list[int]
    reencoded: int = field(default=0)

    @property
    def tokens(self) -> int:
        return self.sums[1]

    def _set(self, leaf: int, length: int, count: int) -> None:
        self.lengths[leaf] = length
        i = len(self.sums) // 2 + leaf
        delta = count - self.sums[i]
        while delta and i:
            self.sums[i] += delta
            i //= 2

    def edit(self, text: str, edits: list[tuple[int, int, str]], encoding: tiktoken.Encoding) -> str:
        """Apply (start, end, new) replacements of ``text``; returns the new text.

        An edit touches the leaves from two characters before it to one after
        it, so every boundary that stays keeps the characters that make it
        safe. Touched leaves become one; the others keep their counts. Edits
        may not overlap; offsets are those of the text before any edit.
        """
        starts = [0, *accumulate(self.lengths)]
        size = len(text)
        leaf_at = lambda p: min(bisect_right(starts, p) - 1, len(self.lengths) - 1)
        regions: list[list] = []
        for start, end, new in sorted(edits):
            first, last = leaf_at(max(0, start - 2)), leaf_at(min(end, max(0, size - 1)))
            if regions and first <= regions[-1][1]:
                regions[-1][1] = max(last, regions[-1][1])
                regions[-1][2].append((start, end, new))
            else:
                regions.append([first, last, [(start, end, new)]])
        parts, at = [], 0
        for first, last, inside in regions:
            low, high = starts[first], starts[last + 1]
            parts.append(text[at:low])
            pieces, here = [], low
            for start, end, new in inside:
                pieces += [text[here:start], new]
                here = end
            pieces.append(text[here:high])
            fresh = "".join(pieces)
            self._set(first, len(fresh), len(encoding.encode_ordinary(fresh)))
            for leaf in range(first + 1, last + 1):
                self._set(leaf, 0, 0)
            self.reencoded += last - first + 1
            parts.append(fresh)
            at = high
        parts.append(text[at:])
        return "".join(parts)


def leaves_of(text: str, points: int = LEAF_POINTS) -> list[str]:
    """The text in runs of pre-tokens of about ``points`` code points."""
    found, at = [], 0
    while at < len(text):
        m = _SAFE.search(text, at + points)
        end = m.start() if m else len(text)
        found.append(text[at:end])
        at = end
    return found or [""]


def build_tree(text: str, encoding: tiktoken.Encoding, points: int = LEAF_POINTS) -> CountTree:
    leaves = leaves_of(text, points)
    counts = [len(encoding.encode_ordinary(x)) for x in leaves]
    width = 1 << max(1, (len(leaves) - 1).bit_length())
    sums = [0] * width + counts + [0] * (width - len(counts))
    for i in range(width - 1, 0, -1):
        sums[i] = sums[2 * i] + sums[2 * i + 1]
    return CountTree([len(x) for x in leaves], sums)


_TREE = "loc string, doc_id long, lengths array<int>, sums array<long>, reencoded long"


def build_trees(docs: DataFrame, loc: str = "loc", vocabulary: str = VOCABULARY) -> DataFrame:
    """loc, doc_id, lengths, sums, reencoded (0) per row of located ``docs``; NULL is the empty text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoder(vocabulary)
        for pdf in batches:
            trees = [build_tree(t, encoding) for t in pdf["text"]]
            yield pd.DataFrame(
                {"loc": pdf["loc"], "doc_id": pdf["doc_id"], "lengths": [t.lengths for t in trees], "sums": [t.sums for t in trees], "reencoded": 0}
            )

    rows = docs.select(F.col(loc).alias("loc"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInPandas(run, _TREE)


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")


def mail_spans(text: str) -> Iterator[tuple[int, int]]:
    """Mail addresses, from each ``@`` to both sides: every character is looked at a bounded number of times."""
    done, at = 0, text.find("@")
    while at >= 0:
        after, start = _DOMAIN.match(text, at + 1), at
        if after:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, after.end()
                done = after.end()
        at = text.find("@", max(at + 1, done))


#: What a clean-up step masks beside mail addresses: long hexadecimal secrets, long numbers.
MASKS = (
    (re.compile(r"\b[0-9A-Fa-f]{24,}\b"), "<SECRET>"),
    (re.compile(r"(?<![\w.])\+?\d[\d ()-]{6,}\d(?!\w)"), "<NUMBER>"),
)
_DIGIT = re.compile(r"[0-9]")


def mask_edits(text: str) -> list[tuple[int, int, str]]:
    """Replacements that mask a text; where two overlap the earlier, then longer one counts."""
    found: list[tuple[int, int, str]] = []
    digits = _DIGIT.search(text) is not None
    found += [(a, b, "<EMAIL>") for a, b in mail_spans(text)]
    if digits:
        found += [(*m.span(), new) for pattern, new in MASKS for m in pattern.finditer(text)]
    kept: list[tuple[int, int, str]] = []
    for edit in sorted(found, key=lambda e: (e[0], -e[1])):
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


def find_edits(docs: DataFrame, loc: str = "loc") -> DataFrame:
    """(loc, text, edits) of the rows of located ``docs`` that a mask changes."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            edits = [[{"start": a, "end": b, "new": n} for a, b, n in mask_edits(t)] for t in pdf["text"]]
            yield pdf.assign(edits=edits)[[bool(e) for e in edits]]

    rows = docs.select(F.col(loc).alias("loc"), whole_text().alias("text")).where(F.col("text").rlike("[0-9@]"))
    return rows.mapInPandas(run, "loc string, text string, edits array<struct<start:int,end:int,new:string>>")


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Updated trees of the rows named in ``edits`` (loc, text, edits), with the new text.

    Reads only edited rows; of these only touched leaves are encoded again.
    """
    small_batches(trees.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoder(vocabulary)
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                tree = CountTree(list(r.lengths), list(r.sums))
                new = tree.edit(r.text, [(e["start"], e["end"], e["new"]) for e in r.edits], encoding)
                rows.append((r.loc, r.doc_id, tree.lengths, tree.sums, tree.reencoded, new))
            out = pd.DataFrame(rows, columns=["loc", "doc_id", "lengths", "sums", "reencoded", "text"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return trees.drop("reencoded").join(edits, "loc").mapInPandas(run, _TREE + ", text string")


def counts_after_masking(docs: DataFrame, loc: str = "loc", vocabulary: str = VOCABULARY) -> DataFrame:
    """Token counts of every row before and after its mask edits.

    loc, doc_id, n_tokens, n_edits, n_tokens_after, n_leaves, n_reencoded.
    NULL and empty texts have no tokens; repeated rows are counted each; an
    empty table gives an empty result.
    """
    trees = write_table(build_trees(docs, loc, vocabulary), "trees")
    edits = write_table(find_edits(docs, loc), "edits")
    new = apply_edits(trees, edits, vocabulary).select("loc", F.get("sums", F.lit(1)).alias("after"), "reencoded")
    numbers = edits.select("loc", F.size("edits").alias("n_edits")).join(new, "loc")
    before = trees.select("loc", "doc_id", F.get("sums", F.lit(1)).alias("n_tokens"), F.size("lengths").cast("long").alias("n_leaves"))
    return before.join(numbers, "loc", "left").select(
        "loc",
        "doc_id",
        "n_tokens",
        F.coalesce("n_edits", F.lit(0)).cast("long").alias("n_edits"),
        F.coalesce("after", "n_tokens").alias("n_tokens_after"),
        "n_leaves",
        F.coalesce("reencoded", F.lit(0)).cast("long").alias("n_reencoded"),
    )
