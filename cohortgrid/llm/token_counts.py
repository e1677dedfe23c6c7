"""Token counts that follow edits.

A segment tree over the pre-tokens of a document holds the characters and tokens below
each node. An edit re-splits the text from the pre-token that could have looked as far
as the edit, to the first old boundary that the new text has too; only these
pre-tokens are encoded, and the sums above their leaves are brought up to date. A leaf may come to hold a
run of pre-tokens, or none; its ends stay boundaries of pre-tokens.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .arrow import slices
from .decontaminate import decode_gaps, encode_gaps
from .encoding import Encoder, encoder, vocabulary

VERSION = "doc_id long, text string, n_tokens long, leaf_chars binary, leaf_tokens binary"
EDITS = "array<struct<start:int,length:int,insert:string>>"

#: What the redaction query takes out of texts: mail and web addresses, numbers of networks, cards and telephones, long keys.
#: Each starts at the edge of a run of its characters, so that a very long run is scanned once.
REDACTIONS = [
    (re.compile(r"(?<![\w.+-])[\w.+-]+@[\w-]+\.[\w.-]+"), "<mail>"),
    (re.compile(r"https?://\S+"), "<url>"),
    (re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}\b"), "<ip>"),
    (re.compile(r"(?<!\w)\+?\d[\d ().-]{6,}\d(?!\w)"), "<number>"),
    (re.compile(r"\b(?=\w*\d)(?=\w*[A-Za-z])\w{20,}\b"), "<key>"),
]


class PretokenTree:
    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.size = 1 << max(0, int(len(chars) - 1).bit_length()) if len(chars) else 1
        self.sums = np.zeros((2 * self.size, 2), np.int64)
        self.sums[self.size : self.size + len(chars)] = np.stack((chars, tokens), 1) if len(chars) else 0
        level = self.size
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level : 2] + self.sums[level + 1 : 2 * level : 2]
            level //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; the last leaf for the text's end."""
        node, start = 1, 0
        position = min(position, max(0, self.chars - 1))
        while node < self.size:
            node *= 2
            left = int(self.sums[node, 0])
            if position - start >= left:
                start += left
                node += 1
        return node - self.size, start

    def put(self, first: int, values: np.ndarray) -> None:
        """Set leaves from ``first`` on and update the sums above them."""
        a, b = first + self.size, first + self.size + len(values)
        self.sums[a:b] = values
        while a > 1:
            a, b = a // 2, (b + 1) // 2
            self.sums[a:b] = self.sums[2 * a : 2 * b : 2] + self.sums[2 * a + 1 : 2 * b : 2]


def edit(tokens: Encoder, text: str, tree: PretokenTree, start: int, length: int, insert: str) -> tuple[str, int]:
    """Replace ``length`` characters at ``start``; returns the new text and how many pre-tokens were encoded."""
    new = text[:start] + insert + text[start + length :]
    moved = len(insert) - length
    # A pre-token is chosen by characters up to one beyond its end, so one that ends two before the edit stands.
    first, begin = tree.find(max(0, start - 2))
    last, at = tree.find(start + length)
    end = at + int(tree.sums[tree.size + last, 0])
    step = 1
    while True:
        goal = end + moved
        stop = min(len(new), goal + 2)
        while stop < len(new) and new[stop - 1].isspace():
            stop += 1
        pieces = tokens.split(new[begin:stop])
        bounds = begin + np.cumsum([0, *map(len, pieces)])
        if goal >= len(new) or goal in bounds:
            break
        for _ in range(step):
            if last + 1 < tree.size:
                last += 1
                end += int(tree.sums[tree.size + last, 0])
        step *= 2
        if last + 1 >= tree.size:
            end = len(text)
    pieces = pieces[: int(np.searchsorted(bounds, min(goal, len(new))))]
    values = np.zeros((last - first + 1, 2), np.int64)
    if pieces:
        each = np.stack((np.fromiter(map(len, pieces), np.int64), tokens.count(pieces)), 1)
        np.add.at(values, np.arange(len(pieces)) * len(values) // len(pieces) if len(pieces) > len(values) else np.arange(len(pieces)), each)
    tree.put(first, values)
    return new, len(pieces)


def _packed(values: np.ndarray) -> bytes:
    return encode_gaps(np.asarray(values, np.int64))[0].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.diff(decode_gaps(data), prepend=0) if data else np.zeros(0, np.int64)


def build_trees(documents: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count whole texts: ``doc_id, text, n_tokens`` and the leaves of the tree.

    A null text is empty and has no leaf. Each row is a document of its own, also where ids are null or
    repeated or rows are equal; an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            leaves = tokens.leaves(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([int(n.sum()) for _, n in leaves], pa.int64()), pa.array([_packed(c) for c, _ in leaves], pa.binary()), pa.array([_packed(n) for _, n in leaves], pa.binary())],
                ["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens"],
            )

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(build, VERSION)


def redactions(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace personal data and secrets, in order and without overlap; the earlier pattern wins."""
    found = sorted((m.start(), k, m.end(), by) for k, (pattern, by) in enumerate(REDACTIONS) for m in pattern.finditer(text))
    out, at = [], 0
    for a, _, b, by in found:
        if a >= at:
            out.append((a, b - a, by))
            at = b
    return out


def apply_edits(versions: DataFrame, tokenizer: str | None = None, find: Callable[[str], list[tuple[int, int, str]]] | None = None) -> DataFrame:
    """Apply the edits that ``find`` sees in each text, or else those of the column ``edits`` (``start, length, insert``).

    Edits are in characters of the old text, in order and without overlap. Returns the new versions, and beside them ``n_chars_before, n_tokens_before, n_edits`` and ``n_encoded``, the
    pre-tokens that were encoded again. Null edits are none; edits beyond the text's end are cut to it.
    """
    tokenizer = tokenizer or vocabulary("byte_bpe_50k.json")
    extra = ["n_chars_before", "n_tokens_before", "n_edits", "n_encoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer)
        for batch in slices(batches, "text"):
            columns: list[list] = [[] for _ in range(9)]
            for doc_id, text, n_tokens, chars, counts, given in zip(*(c.to_pylist() for c in batch.columns)):
                new, encoded = text or "", 0
                edits = find(new) if find else [(e["start"], e["length"], e["insert"] or "") for e in given or ()]
                if edits:
                    tree = PretokenTree(_unpacked(chars), _unpacked(counts))
                    for start, length, insert in reversed(edits):
                        start = min(start, len(new))
                        new, n = edit(tokens, new, tree, start, min(length, len(new) - start), insert)
                        encoded += n
                    leaves = tree.sums[tree.size :]
                    leaves = leaves[leaves[:, 0] > 0]
                    after, chars, counts = tree.tokens, _packed(leaves[:, 0]), _packed(leaves[:, 1])
                else:
                    after = n_tokens
                for column, value in zip(columns, (doc_id, new, after, chars, counts, len(text or ""), n_tokens, len(edits), encoded)):
                    column.append(value)
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", *extra])

    edits = F.lit(None) if find else F.col("edits")
    rows = versions.select("doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens", edits.cast(EDITS).alias("edits"))
    return rows.mapInArrow(run, VERSION + "".join(f", {c} long" for c in extra))


def edit_aware_counts(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Count all documents, redact them, and count again by the trees alone.

    One row per row of the table: ``doc_id, n_chars, n_tokens, n_edits, n_encoded, n_chars_after,
    n_tokens_after``. A null text is empty and has no edits. Ids may be null or repeated, and equal rows stay apart;
    an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    versions = materialise(build_trees(documents, tokenizer), "versions")
    out = apply_edits(versions, tokenizer, redactions)
    return out.select("doc_id", F.col("n_chars_before").alias("n_chars"), F.col("n_tokens_before").alias("n_tokens"), "n_edits", "n_encoded", F.length("text").cast("long").alias("n_chars_after"), F.col("n_tokens").alias("n_tokens_after"))
